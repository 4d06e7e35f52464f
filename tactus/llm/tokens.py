"""Exact batch encoding with a public tokenizer, each distinct piece of text once.

A byte-level or word-level BPE never merges across the places where its pattern splits, so a text's ids are the ids of
its pieces one after another. Texts are cut at single white-space characters, where both patterns always split; the
distinct pieces of a batch go to the tokenizers library, known ones come from a bounded cache of the worker process.
Texts with longer runs of white space or characters outside the plain range go to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White-space pairs, or characters whose white space or lower case the libraries may see differently.
_WHOLE_SPACED = r"[\s\x0b\x1c-\x1f][\s\x0b\x1c-\x1f]|[\x0b\x0c\x0d\x09\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_PLAIN = r"^[\x00-\x08\x0a\x0e-\x1b\x20-\x{84}\x{86}-\x{9f}\x{a1}-\x{12f}]*$"
CACHE = 400_000  # pieces that a worker process remembers, unless it is told otherwise


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The spans of ``flat`` one after another."""
    done = np.cumsum(size)
    return flat[np.repeat(begin - (done - size), size) + np.arange(int(done[-1]) if len(done) else 0)]


class Encoder:
    """Ids of texts by a tokenizer file; ``spaced``: a space belongs to the word after it (byte-level), else it is dropped."""

    def __init__(self, path: str, spaced: bool, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        self.spaced, self.cache = spaced, cache
        size = self.lib.get_vocab_size()
        self.kind = np.dtype("<u4" if size > 65535 else "<u2")
        vocab = self.lib.get_vocab()
        # ids that begin a word after a space, or that end a word: they part the ids of words encoded together
        self.border = np.zeros(size, bool)
        self.border[[i for t, i in vocab.items() if (t.startswith("Ġ") if spaced else t.endswith("</w>"))]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys = pa.array([], pa.string())
        self.flat, self.begin, self.size = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _fresh(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of letter runs, each after a space if ``spaced``, and their numbers; many words make one text."""
        ids = np.array(self.lib.encode(("" if self.spaced else " ").join(words), add_special_tokens=False).ids, self.kind)
        at = np.flatnonzero(self.border[ids])
        size = np.diff(np.append(at, len(ids))) if self.spaced else np.diff(at + 1, prepend=0)
        if len(size) != len(words) or size.sum() != len(ids):
            each = self._fresh(words)
            return np.concatenate(each), np.array([len(x) for x in each])
        return ids, size

    def _slots(self, wanted: pa.Array) -> np.ndarray:
        """Where each of the distinct strings stands among ``keys``, after new ones are encoded."""
        if len(self.keys) > self.cache:
            self._forget()
        new = wanted.filter(pc.invert(pc.is_in(wanted, value_set=self.keys)))
        body = pc.utf8_ltrim(new, " ") if self.spaced else new
        runs = pc.utf8_is_alpha(body)
        if self.spaced:
            runs = pc.and_(runs, pc.equal(pc.utf8_length(new), pc.add(pc.utf8_length(body), 1)))
        words, others = new.filter(runs), new.filter(pc.invert(runs))
        ids, sizes = [self.flat], [self.size]
        listed = words.to_pylist()
        for i in range(0, len(listed), 2000):
            got, size = self._words(listed[i : i + 2000])
            ids.append(got)
            sizes.append(size)
        each = self._fresh(others.to_pylist())
        ids += each
        sizes.append(np.array([len(x) for x in each], np.int64))
        self.keys = pa.concat_arrays([self.keys, words, others])
        self.flat, self.size = np.concatenate(ids), np.concatenate(sizes).astype(np.int64)
        self.begin = np.cumsum(self.size) - self.size
        return pc.index_in(wanted, value_set=self.keys).to_numpy(zero_copy_only=False).astype(np.int64)

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each distinct piece and their numbers. A letter run before one full stop or comma is looked up without it."""
        n = len(pieces)
        lead = np.zeros(n, np.int64)
        if self.spaced:  # "\nBar" is a line's first word: a newline, then the word without a space; others stand after a space
            line = pc.starts_with(pieces, "\n")
            lead = line.to_numpy(zero_copy_only=False).astype(np.int64)
            pieces = pc.if_else(line, pc.utf8_slice_codeunits(pieces, 1), pc.binary_join_element_wise(" ", pieces, ""))
        stem = pc.utf8_slice_codeunits(pieces, 0, -1)
        mark = pc.utf8_slice_codeunits(pieces, -1, None) if n else pieces
        tailed = pc.and_(pc.is_in(mark, value_set=pa.array([".", ","])), pc.utf8_is_alpha(pc.utf8_ltrim(stem, " ") if self.spaced else stem))
        if self.spaced:
            tailed = pc.and_(tailed, pc.invert(pc.starts_with(stem, "  ")))
        key = pc.if_else(tailed, stem, pieces).dictionary_encode()
        fixed = ["\n", ".", ","]
        slots = self._slots(pc.unique(pa.concat_arrays([key.dictionary, pa.array(fixed)])))
        # the keys stand first among the distinct strings, in their order
        single = dict(zip(fixed, pc.index_in(pa.array(fixed), value_set=self.keys).to_pylist(), strict=True))
        slot = slots[key.indices.to_numpy()]
        tail = tailed.to_numpy(zero_copy_only=False).astype(np.int64)
        size = self.size[slot]
        whole = lead + size + tail
        end = np.cumsum(whole)
        out = np.empty(int(end[-1]) if n else 0, self.kind)
        inside = np.ones(len(out), bool)
        at = (end - whole)[lead > 0]
        out[at] = self.flat[self.begin[single["\n"]]] if self.spaced else 0
        inside[at] = False
        dots = pc.equal(mark, ".").to_numpy(zero_copy_only=False)
        for char, of in ((".", dots), (",", ~dots)):
            at = end[(tail > 0) & of] - 1
            out[at] = self.flat[self.begin[single[char]]]
            inside[at] = False
        out[inside] = _gather(self.flat, self.begin[slot], size)
        return out, whole

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of each text's among them (one more than texts)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        n = len(texts)
        whole = pc.match_substring_regex(texts, _WHOLE_SPACED).to_numpy(zero_copy_only=False)
        if not self.spaced:
            whole = whole | ~pc.match_substring_regex(texts, _PLAIN).to_numpy(zero_copy_only=False)
        if not whole.any():
            ids, counts = self._encode_plain(texts)
            return ids, np.concatenate([[0], np.cumsum(counts)])
        at = np.flatnonzero(whole)
        parts = self._fresh(texts.take(pa.array(at)).to_pylist())
        rest, rest_counts = self._encode_plain(texts.filter(pa.array(~whole)))
        counts = np.zeros(n, np.int64)
        counts[at], counts[~whole] = [len(x) for x in parts], rest_counts
        ends = np.cumsum(counts)
        ids = np.empty(int(ends[-1]), self.kind)
        ids[np.repeat(whole, counts)] = np.concatenate(parts)
        ids[np.repeat(~whole, counts)] = rest
        return ids, np.concatenate([[0], ends])

    def _encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        if self.spaced:
            # a text's own start is marked as a line's, and that newline's id is taken off again below
            cut = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")
        else:
            cut = pc.split_pattern(pc.utf8_lower(pc.replace_substring(texts, "\n", " ")), " ")
        values = cut.flatten().dictionary_encode()
        ends = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
        flat, size = self._distinct(values.dictionary)
        code = values.indices.to_numpy()
        lens, begin = size[code], (np.cumsum(size) - size)[code]
        if self.spaced:
            lens[ends[:-1]] -= 1
            begin[ends[:-1]] += 1
        return _gather(flat, begin, lens), np.diff(np.concatenate([[0], np.cumsum(lens)])[ends])


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool, cache: int = CACHE) -> Encoder:
    """This worker process's encoder of the file, which remembers so many pieces."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = Encoder(path, spaced, cache)
    return _ENCODERS[path, spaced]


def slices(batch: pa.RecordBatch, rows: int = 4096, text_bytes: int = 4 << 20, column: str = "text"):
    """Parts of a batch of at most so many rows and about so many bytes of text; one long text is a part of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = int(np.searchsorted(size, before + text_bytes, "right"))
        end = min(max(end, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end
