"""SentencePiece encoding and decoding of byte-pair models by vectorised merge rounds.

A text is a white-space mark and its characters, each white space another mark. No piece of the models that are read here holds a mark after
another character, so every mark begins a word of its own and words are encoded alone, the distinct ones of a batch at once: their
symbols lie one after another in a flat array. A round finds the rank of every pair of neighbours, the least of each word, and merges all its
places from the left at the same time; words without a pair leave the arrays. Merging all places of a pair equals the library's order, one merge after
another, unless a merged symbol makes a pair of no greater rank with a neighbour as it stands then; such a word merges its leftmost place only in that
round. Pieces of marks alone have the last rank in common, so runs of single marks are merged at the end, from the left, in blocks of the longest
such piece. Characters without a piece become the pieces of their bytes.

Between two characters that stand together in no piece nothing is merged, so words are cut there: very long ones take rounds by their parts.

Null texts count as empty: they have the begin and end ids only. Any other text, of any length, gives a row for each row of the input; repeated
rows give repeated rows, and an empty table gives none. Further columns of the input may have any names; they aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tactus.llm.common import release
from tactus.llm.tokens import _gather, slices, tokenizer_path

MARK = "▁"
CACHE = 500_000  # words that a worker process remembers
#: Symbols of characters without a piece: this and the code point.
_RAW = 1 << 24
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_NONE = np.iinfo(np.int32).max


class PieceModel:
    """Tables of a model file: pairs of symbols, the rank and the symbol of each, and the bytes of each piece."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        kinds = np.array([p.type for p in model.pieces])
        plain = norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        if spec.model_type != 2 or not spec.byte_fallback or not plain or spec.treat_whitespace_as_suffix or set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only byte-pair models with byte pieces, no normalisation and a leading mark are read")
        self.begin_id, self.end_id = spec.bos_id, spec.eos_id
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        spaces = {p for p in normal if set(p) == {MARK}}
        worst = min(model.pieces[i].score for i in normal.values())
        longest = max(map(len, spaces))
        if any(MARK in p[1:] for p in normal if p not in spaces) or any(model.pieces[normal[p]].score != worst for p in spaces - {MARK}):
            raise ValueError("a piece holds a mark after another character, or runs of marks have no common last rank")
        self.mark = normal[MARK]
        # the piece that begins at each place of a run of each length, -1 inside a piece; the longest piece ends a block
        self.blocks = np.full((longest + 1, longest), -1)
        for n in range(1, longest + 1):
            at = 0
            for k in _from_first([1] * n, {len(p) for p in spaces}):
                self.blocks[n, at] = normal[MARK * k]
                at += k
        if self.blocks[longest, 0] != normal[MARK * longest]:
            raise ValueError("the longest run of marks isn't reached by merges")
        missing = sorted({c for p in normal for c in p} - normal.keys())
        if missing:
            raise ValueError(f"characters of pieces without a piece of their own: {missing[:5]}")
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        # the same score is the same rank; greater scores come first
        rank_of = {s: k for k, s in enumerate(sorted({model.pieces[i].score for i in normal.values()}, reverse=True))}
        self.width, found, met = len(model.pieces), [], set()
        for p, i in normal.items():
            if p in spaces:
                continue
            met.update(zip(p[:-1], p[1:], strict=True))
            found += [(normal[p[:k]] * self.width + normal[p[k:]], rank_of[model.pieces[i].score], i) for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
        self.pair, self.rank, self.made = (np.array(x) for x in zip(*sorted(found), strict=True))
        self.met = np.array(sorted(ord(a) << 21 | ord(b) for a, b in met), np.int64)
        self.byte_ids = np.zeros(256, np.int64)
        raw = []
        for i, p in enumerate(model.pieces):
            if p.type == _BYTE:
                value = int(p.piece[3:-1], 16)
                self.byte_ids[value] = i
                raw.append(bytes([value]))
            else:
                raw.append({_CONTROL: "", _UNKNOWN: spec.unk_surface}.get(p.type, p.piece.replace(MARK, " ")).encode())
        self.raw, self.raw_size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw])
        self.raw_begin = np.cumsum(self.raw_size) - self.raw_size
        self.is_byte, self.is_silent = kinds == _BYTE, kinds == _CONTROL
        self.marked = np.array([p.type == _NORMAL and p.piece.startswith(MARK) for p in model.pieces])
        self.keys = pa.array([], pa.string())
        self._forget()

    def _forget(self) -> None:
        self.keys = pa.array([], pa.string())
        self.flat, self.begin, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; no rank where no piece is made."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = (self.pair[at] == key) & (left < _RAW) & (right < _RAW)
        return np.where(hit, self.rank[at], _NONE), np.where(hit, self.made[at], -1)

    def merged(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of words that lie one after another, when no pair can be merged, and their words."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols) > 1:
            same = word[1:] == word[:-1]
            rank, made = self._ranks(symbols[:-1], symbols[1:])
            rank = np.append(np.where(same, rank, _NONE), _NONE)
            starts = np.flatnonzero(np.append(True, ~same))
            count = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            live = np.repeat(least < _NONE, count)
            if not live.all():  # compaction: finished words leave
                done.append((symbols[~live], word[~live]))
                symbols, word, rank, made = symbols[live], word[live], rank[live], np.append(made, -1)[live][:-1]
                count, least = count[least < _NONE], least[least < _NONE]
                if not len(symbols):
                    break
            best = np.repeat(least, count)
            chosen = self._from_left(rank == best)
            unsafe = self._unsafe(symbols, word, made, chosen, best)
            if len(unsafe):
                first = np.zeros(len(symbols), bool)
                at = np.flatnonzero(chosen)
                _, lead = np.unique(word[at], return_index=True)
                first[at[lead]] = True
                chosen &= first | ~np.isin(word, unsafe)
            symbols, keep = self._apply(symbols, made, chosen)
            word = word[keep]
        done.append((symbols, word))
        symbols, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    @staticmethod
    def _from_left(mask: np.ndarray) -> np.ndarray:
        """Of neighbouring marked places the first, third and so on: merges that don't overlap."""
        at = np.flatnonzero(mask)
        head = np.append(True, np.diff(at) > 1) if len(at) else np.zeros(0, bool)
        nth = np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        out = np.zeros(len(mask), bool)
        out[at[nth % 2 == 0]] = True
        return out

    @staticmethod
    def _apply(symbols: np.ndarray, made: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = symbols.copy()
        at = np.flatnonzero(chosen)
        out[at] = made[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        return out[keep], keep

    def _unsafe(self, symbols: np.ndarray, word: np.ndarray, made: np.ndarray, chosen: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Words in which a merge makes a pair that would come before the next place of the same rank."""
        at = np.flatnonzero(chosen)
        after, keep = self._apply(symbols, made, chosen)
        place = np.cumsum(keep) - 1
        out = []
        for left, right, own in ((after[place[at] - 1], after[place[at]], (at > 0) & (word[at - 1] == word[at])), (after[place[at]], symbols[np.minimum(at + 2, len(symbols) - 1)], (at + 2 < len(symbols)) & (word[np.minimum(at + 2, len(symbols) - 1)] == word[at]))):
            rank, _ = self._ranks(left, right)
            out.append(word[at[own & (rank <= best[at])]])
        # the merged symbol with a merged neighbour is seen as that neighbour's left pair
        return np.unique(np.concatenate(out))

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, each after a mark, and their numbers."""
        marked = pc.binary_join_element_wise(MARK, words, "")
        size = pc.utf8_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
        points = np.frombuffer("".join(marked.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(words)), size)
        ids = self.char_ids[points].astype(np.int64)
        symbols = np.where(ids >= 0, ids, points + _RAW)
        code = points[:-1] << 21 | points[1:]
        apart = self.met[np.minimum(np.searchsorted(self.met, code), len(self.met) - 1)] != code
        part = np.cumsum(np.append(True, apart | (word[1:] != word[:-1]))) - 1  # parts of words, each for itself
        of = word[np.flatnonzero(np.append(True, part[1:] != part[:-1]))]
        symbols, part = self.merged(symbols, part)
        word = of[part]
        return self._with_bytes(symbols, word, len(words))

    def _with_bytes(self, symbols: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        raw = symbols >= _RAW
        width = np.ones(len(symbols), np.int64)
        if raw.any():
            points = symbols[raw] - _RAW
            width[raw] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            own = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
            out = np.repeat(symbols, width)
            out[np.repeat(raw, width)] = self.byte_ids[own]
            symbols = out
        return symbols.astype(np.int32), np.bincount(word, weights=width, minlength=n).astype(np.int64)

    def _slots(self, wanted: pa.Array) -> np.ndarray:
        """Where each distinct word stands among the known ones, after new ones are encoded."""
        if len(self.keys) > CACHE:
            self._forget()
        new = wanted.filter(pc.invert(pc.is_in(wanted, value_set=self.keys)))
        if len(new):
            ids, size = self._encoded(new)
            self.keys = pa.concat_arrays([self.keys, new])
            self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, size])
            self.begin = np.cumsum(self.size) - self.size
        return pc.index_in(wanted, value_set=self.keys).to_numpy(zero_copy_only=False).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with begin and end ids, and the offsets of each text's (one more than texts)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        n = len(texts)
        cut = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
        values = cut.flatten().dictionary_encode()
        ends = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
        slot = self._slots(values.dictionary)[values.indices.to_numpy()]
        filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        used = np.repeat(filled, np.diff(ends))  # an empty text has no mark either
        text = np.repeat(np.arange(n), np.diff(ends))[used]
        size = self.size[slot[used]]
        ids, owner = _gather(self.flat, self.begin[slot[used]], size), np.repeat(text, size)
        ids, owner = self._runs(ids, owner)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
        ids = np.insert(ids, np.repeat(cuts, 2)[1:-1], np.tile([self.begin_id, self.end_id], n))
        return ids, cuts + 2 * np.arange(n + 1)

    def _runs(self, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of single marks become pieces of several."""
        mark = ids == self.mark
        if not mark.any():
            return ids, owner
        joined = np.append(False, mark[1:] & mark[:-1] & (owner[1:] == owner[:-1]))
        head = np.flatnonzero(mark & ~joined)
        length = np.diff(np.append(np.cumsum(mark)[head] - 1, mark.sum()))
        nth = np.arange(int(mark.sum())) - np.repeat(np.cumsum(length) - length, length)
        longest, out = self.blocks.shape[1], ids.copy()
        block = nth // longest * longest
        out[mark] = self.blocks[np.minimum(np.repeat(length, length) - block, longest), nth - block]
        return out[out >= 0], owner[out >= 0]

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each span of ids. Of a leading piece's mark nothing is left; a byte that is part of no character becomes U+FFFD."""
        out = []
        size, begin = self.raw_size[ids], self.raw_begin[ids]
        text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        heard = np.flatnonzero(~self.is_silent[ids])
        lead = heard[np.flatnonzero(np.append(True, text[heard][1:] != text[heard][:-1]))] if len(heard) else heard
        lead = lead[self.marked[ids[lead]]]
        size[lead] -= 1
        begin[lead] += 1
        flat = _gather(self.raw, begin, size).tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            piece = flat[ends[a] : ends[b]]
            byte = self.is_byte[ids[a:b]]
            if byte.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[False], byte, [False]]).astype(np.int8)))
                parts, at = [], ends[a]
                for i, j in zip(edge[::2], edge[1::2], strict=True):
                    parts += [flat[at : ends[a + i]], _repaired(flat[ends[a + i] : ends[a + j]])]
                    at = ends[a + j]
                piece = b"".join([*parts, flat[at : ends[b]]])
            out.append(piece)
        return out


def _from_first(run: list[int], sizes: set[int]) -> list[int]:
    """A run after merging, again and again, the first neighbours whose sum is one of ``sizes``."""
    while (at := next((i for i in range(len(run) - 1) if run[i] + run[i + 1] in sizes), None)) is not None:
        run = [*run[:at], run[at] + run[at + 1], *run[at + 2 :]]
    return run


def _repaired(raw: bytes) -> bytes:
    """Valid UTF-8: each byte outside a character becomes U+FFFD."""
    out = []
    while raw:
        try:
            raw.decode()
            return b"".join([*out, raw])
        except UnicodeDecodeError as e:
            out += [raw[: e.start], "�".encode()]
            raw = raw[e.start + 1 :]
    return b"".join(out)


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """This worker process's tables of the file."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the begin id, the text's pieces, the end id. ``model``: a SentencePiece file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = piece_model(model)
        for batch in batches:
            for part in slices(batch, 4096, 4 << 20):
                ids, cuts = use.encode(part["text"])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])
            release()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, ids array<int>")


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of a list column; a null list is empty."""
    column = pc.fill_null(column, pa.scalar([], column.type)) if column.null_count else column
    cuts = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[cuts[0] : cuts[-1]].astype(np.int64), cuts - cuts[0]


def _parts(batch: pa.RecordBatch, tokens: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about so many ids; one long document is a part of its own."""
    cuts, at = batch["ids"].offsets.to_numpy(), 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + tokens, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, text of rows (doc_id, ids); a null list gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = piece_model(model)
        for batch in batches:
            for part in _parts(batch):
                texts = pa.array(use.decode(*_listed(part["ids"])), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["ids"], texts], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 of the ids as little-endian unsigned 32-bit integers, decoded_sha256 of the text's UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cuts = _listed(batch["ids"])
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B") if len(ids) else memoryview(b"")
            sums = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.diff(cuts)), pa.array(sums, pa.string()), batch["decoded_sha256"]], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return decoded.select("doc_id", "ids", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    return digests(decode_documents(encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), model), model))
