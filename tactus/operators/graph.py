"""Graphs of nodes (id, type, name, ...) and edges (source, target, type, detail): resolution, coupling, cycles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tactus.operators.storage import saved


def first_by_id(nodes: DataFrame, order: list) -> DataFrame:
    """One node per id, the first in order."""
    return nodes.withColumn("_k", F.row_number().over(Window.partitionBy("id").orderBy(*order))).where(F.col("_k") == 1).drop("_k")


def resolve(calls: DataFrame, functions: DataFrame, methods: DataFrame) -> DataFrame:
    """caller, target of calls (caller, module, klass, name): the module's function, else the own class's method of a ``self.`` call, else ``ref:`` and the name."""
    f = functions.select("module", "name", F.col("id").alias("_f"))
    m = methods.select("module", "klass", F.concat(F.lit("self."), "name").alias("name"), F.col("id").alias("_m"))
    return calls.join(f, ["module", "name"], "left").join(m, ["module", "klass", "name"], "left").select("caller", F.coalesce("_f", "_m", F.concat(F.lit("ref:"), "name")).alias("target"))


def resolve_bases(bases: DataFrame, classes: DataFrame) -> DataFrame:
    """klass, target of base classes (klass, module, name): the module's own class, else ``ref:`` and the name."""
    c = classes.select("module", "name", F.col("id").alias("_c"))
    return bases.join(c, ["module", "name"], "left").select("klass", F.coalesce("_c", F.concat(F.lit("ref:"), "name")).alias("target"))


def between(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges whose both ends are nodes (id)."""
    ids = nodes.select("id").distinct()
    return edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")


def build(rows: DataFrame, dependencies: DataFrame | None = None, project: str = "project") -> tuple[DataFrame, DataFrame]:
    """Nodes (one per id) and distinct edges of scanned sources (see ``sources.code.scan``), with calls and base classes resolved; ``dependencies`` (name) hang on the project."""
    found = rows.where("kind = 'node'").select(F.col("source").alias("id"), "type", "name", "file", "lineno", F.col("detail").alias("doc"))
    module = lambda c: F.regexp_extract(c, r"^[a-z]+:([^.]*)", 1)
    known = found.withColumn("module", module("id"))
    methods = known.where("type = 'method'").withColumn("klass", F.regexp_extract("id", r"^method:[^.]*\.(.*)\.[^.]*$", 1))
    edges = rows.where("kind = 'edge'")
    calls = edges.where("type = 'CALLS'").select(F.col("source").alias("caller"), module("source").alias("module"), F.col("detail").alias("klass"), "name")
    bases = edges.where("type = 'INHERITS'").select(F.col("source").alias("klass"), module("source").alias("module"), F.regexp_replace("target", "^ref:", "").alias("name"))
    edge = lambda df, source, kind: df.select(F.col(source).alias("source"), "target", F.lit(kind).alias("type"))
    out = edges.where("type in ('CONTAINS', 'IMPORTS')").select("source", "target", "type").unionByName(edge(resolve(calls, known.where("type = 'function'"), methods), "caller", "CALLS")).unionByName(edge(resolve_bases(bases, known.where("type = 'class'")), "klass", "INHERITS"))
    nodes = found
    if dependencies is not None:
        own = dependencies.select(F.concat(F.lit("package:"), "name").alias("id"), F.lit("package").alias("type"), "name", F.lit("").alias("file"), F.lit(0).alias("lineno"), F.lit("").alias("doc"))
        nodes = nodes.unionByName(own)
        out = out.unionByName(own.select(F.lit(f"project:{project}").alias("source"), F.col("id").alias("target"), F.lit("DEPENDS_ON").alias("type")))
    return first_by_id(nodes, ["file", "lineno", "type"]), out.distinct()


def coupling(edges: DataFrame, k: int = 12) -> DataFrame:
    """The k nodes with most neighbours: out and in counts of distinct edges, by total, out, in and name, descending."""
    e = edges.where("source <> target").select("source", "target").distinct()
    ends = e.select(F.col("source").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(e.select(F.col("target").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return ends.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree")).withColumn("total", F.col("out_degree") + F.col("in_degree")).orderBy(F.desc("total"), F.desc("out_degree"), F.desc("in_degree"), F.desc("node")).limit(k)


def top_targets(edges: DataFrame, k: int = 15) -> DataFrame:
    return edges.groupBy("target").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "target").limit(k)


def strong_components(edges: DataFrame) -> DataFrame:
    """node, root of the nodes that lie on a cycle of at least two nodes: root is the greatest node of its strongly connected component.

    Nodes without edges in or out are trimmed first. Then each node takes the greatest label that reaches it; a node that keeps its own is a root, and the
    nodes of its label that reach it back are its component. These leave, and so do edges between labels; what is left goes round again. Every round is
    stored, and there are as many as the longest of the shortest ways in the graph."""
    a_b = edges.where("source <> target").select(F.col("source").alias("a"), F.col("target").alias("b")).distinct()
    e, found = _trimmed(saved(a_b)), []
    while not e.isEmpty():
        label = saved(e.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")))
        while True:
            sent = e.join(label, F.col("a") == F.col("node")).select(F.col("b").alias("node"), "label")
            new = saved(sent.unionByName(label).groupBy("node").agg(F.max("label").alias("label")))
            if new.join(label.withColumnRenamed("label", "old"), "node").where("label <> old").isEmpty():
                break
            label = new
        own = lambda c: label.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
        inside = saved(e.join(own("a"), "a").join(own("b"), "b").where("label_a = label_b").select("a", "b", F.col("label_a").alias("label")))
        members = saved(label.where("node = label"))
        front = members
        while not front.isEmpty():
            back = inside.join(front.select(F.col("node").alias("b"), "label"), ["b", "label"]).select(F.col("a").alias("node"), "label").distinct()
            front = saved(back.join(members, "node", "left_anti"))
            members = saved(members.unionByName(front))
        found.append(members.select("node", F.col("label").alias("root")))
        gone = members.select("node")
        e = _trimmed(saved(inside.join(gone.withColumnRenamed("node", "a"), "a", "left_anti").join(gone.withColumnRenamed("node", "b"), "b", "left_anti").select("a", "b")))
    if not found:
        return a_b.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    every = reduce(DataFrame.unionByName, found)
    return every.join(every.groupBy("root").count().where("count > 1").select("root"), "root", "left_semi").select("node", "root")


def _trimmed(e: DataFrame) -> DataFrame:
    """The edges (a, b) left when nodes without an edge in or out are taken away, again and again."""
    n = e.count()
    while n:
        kept = saved(e.join(e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").join(e.select(F.col("a").alias("b")).distinct(), "b", "left_semi"))
        if (now := kept.count()) == n:
            break
        e, n = kept, now
    return e


def cycles(edges: DataFrame, depth: int = 20) -> DataFrame:
    """Simple cycles of at most ``depth`` nodes, each once, from its least node. Only edges inside strongly connected components are walked. Paths grow by one join
    a round and are stored; only paths whose nodes all exceed their first are kept, so a cycle is found from one start. The number of paths
    grows with that of cycles."""
    loops = edges.where("source = target").select(F.array("source").alias("path")).distinct()
    root = saved(strong_components(edges))
    own = lambda c: root.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    e = edges.where("source <> target").select(F.col("source").alias("a"), F.col("target").alias("b")).distinct()
    e = saved(e.join(own("a"), "a").join(own("b"), "b").where("root_a = root_b").select("a", "b"))
    paths, found = e.where("b > a").select(F.array("a", "b").alias("path")), [loops]
    for _ in range(depth - 1):
        step = saved(paths.join(e, F.element_at("path", -1) == F.col("a")).where((F.col("b") == F.col("path")[0]) | ((F.col("b") > F.col("path")[0]) & ~F.array_contains("path", F.col("b")))).select("path", "b"))
        if step.isEmpty():
            break
        found.append(step.where(F.col("b") == F.col("path")[0]).select("path"))
        paths = step.where(F.col("b") != F.col("path")[0]).select(F.concat("path", F.array("b")).alias("path"))
    return reduce(DataFrame.unionByName, found).select(F.size("path").alias("length"), "path").orderBy("length", "path")


def mermaid(edges: DataFrame) -> DataFrame:
    """value: the lines of a Mermaid graph, its head and the distinct edges in order; a table of lines, so that no row holds all edges."""
    lines = edges.select(F.lit(1).alias("k"), F.concat(F.lit("  "), "source", F.lit(" --> "), "target").alias("value")).distinct()
    head = edges.sparkSession.createDataFrame([(0, "graph LR")], "k int, value string")
    return head.unionByName(lines).orderBy("k", "value").select("value")


def resolve_imports(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """source, target of the imports of modules: the module of that name among ``nodes``, else ``package:`` and the name's first part; edges of other types are left out."""
    named = edges.where("type = 'IMPORTS' and source like 'module:%'").select("source", F.regexp_replace("target", "^import:", "").alias("name"))
    modules = nodes.where("type = 'module'").select("name", F.col("id").alias("module")).groupBy("name").agg(F.min("module").alias("module"))
    # a module is known by the last part of its dotted name
    found = named.withColumn("last", F.substring_index("name", ".", -1)).join(modules.withColumnRenamed("name", "last"), "last", "left")
    return found.select("source", F.coalesce("module", F.concat(F.lit("package:"), F.substring_index("name", ".", 1))).alias("target"))


def within(edges: DataFrame, prefix: str) -> DataFrame:
    """The edges between different nodes whose names, after the kind, both begin with ``prefix``."""
    own = lambda c: F.substring_index(c, ":", -1).startswith(prefix)
    return edges.where(own("source") & own("target") & (F.col("source") != F.col("target")))


def _lines(rows: DataFrame, part: int, value: Column, *order: Column) -> DataFrame:
    """place, value: lines of a part of a text, in order."""
    w = Window.orderBy(*order)
    return rows.select(F.struct(F.lit(part).alias("part"), F.row_number().over(w).alias("k")).alias("place"), value.alias("value"))


def _text(spark: SparkSession, part: int, *lines: str) -> DataFrame:
    return spark.createDataFrame([((part, k), x) for k, x in enumerate(lines)], "place struct<part: int, k: int>, value string")


def dependency_report(imports: DataFrame, prefixes: tuple[str, ...] = ("",), k: int = 12, packages: int = 15, depth: int = 20) -> DataFrame:
    """place, value: the lines of a Markdown report on imports (source, target): for each prefix the modules most coupled and the cycles, then the packages most used. Only the k first rows of
    each table, and cycles, become lines."""
    spark, name, parts = imports.sparkSession, lambda c: F.substring_index(c, ":", -1), []
    parts.append(_text(spark, 0, "# Dependency Maps & Coupling Report"))
    for n, prefix in enumerate(prefixes):
        own, at = within(imports.where("target like 'module:%'"), prefix), 10 * n + 1
        parts.append(_text(spark, at, "", f"## {prefix or 'all modules'}: coupling", "", "| Module | Imports (out) | Imported by (in) | Total |", "|---|---:|---:|---:|"))
        row = F.format_string("| `%s` | %d | %d | %d |", name("node"), F.col("out_degree"), F.col("in_degree"), F.col("total"))
        parts.append(_lines(coupling(own, k), at + 1, row, F.desc("total"), F.desc("in_degree"), F.desc("out_degree"), F.desc("node")))
        found = cycles(own, depth)
        parts.append(_text(spark, at + 2, "", f"## {prefix or 'all modules'}: cycles", "", *(["- none"] if found.isEmpty() else [])))
        shown = F.concat(F.lit("- "), F.array_join(F.transform("path", lambda x: F.concat(F.lit("`"), name(x), F.lit("`"))), " -> "))
        parts.append(_lines(found, at + 3, shown, F.col("length"), F.col("path")))
    last = 10 * len(prefixes) + 1
    parts.append(_text(spark, last, "", "## Packages", "", "| Package | Import references |", "|---|---:|"))
    used = top_targets(imports.where("target like 'package:%'"), packages)
    parts.append(_lines(used, last + 1, F.format_string("| `%s` | %d |", name("target"), F.col("n")), F.desc("n"), F.col("target")))
    return reduce(DataFrame.unionByName, parts).orderBy("place")


def _escaped(c: str) -> Column:
    out = F.coalesce(F.col(c).cast("string"), F.lit(""))
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(mark), F.lit(name))
    return out


#: The first lines of a GraphML document with the keys that follow.
_GRAPHML = '<?xml version="1.0" encoding="UTF-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">'


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """place, value: the lines of one GraphML document, a row a node or edge, so that no row holds the graph."""
    fields = [c for c in ("type", "name", "file", "lineno") if c in nodes.columns]
    place = lambda part, key: F.struct(F.lit(part).alias("part"), key.alias("key"))
    data = lambda c, key: F.concat(F.lit(f'<data key="{key}">'), _escaped(c), F.lit("</data>"))
    n = nodes.select(place(1, F.col("id")).alias("place"), F.concat(F.lit('<node id="'), _escaped("id"), F.lit('">'), *(data(c, c) for c in fields), F.lit("</node>")).alias("value"))
    key = F.concat_ws("\x00", "source", "target", "type")
    e = edges.select(place(2, key).alias("place"), F.concat(F.lit('<edge source="'), _escaped("source"), F.lit('" target="'), _escaped("target"), F.lit('">'), data("type", "kind"), F.lit("</edge>")).alias("value"))
    keys = "".join(f'\n<key id="{c}" for="node" attr.name="{c}" attr.type="{"int" if c == "lineno" else "string"}"/>' for c in fields)
    head = f'{_GRAPHML}{keys}\n<key id="kind" for="edge" attr.name="type" attr.type="string"/>\n<graph edgedefault="directed">'
    ends = nodes.sparkSession.createDataFrame([((0, ""), head), ((3, ""), "</graph>\n</graphml>")], "place struct<part: int, key: string>, value string")
    return ends.unionByName(n).unionByName(e)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges as JSON lines in order, their numbers and the time of writing beside them, the edges as Mermaid lines, and a GraphML document in parts of a range
    sort, to be read in the order of their names."""
    nodes.orderBy("id").write.mode("overwrite").json(f"{path}/nodes")
    edges.orderBy("source", "target", "type").write.mode("overwrite").json(f"{path}/edges")
    counts = nodes.agg(F.count(F.lit(1)).alias("nodes")).crossJoin(edges.agg(F.count(F.lit(1)).alias("edges"))).withColumn("at", F.current_timestamp())
    counts.write.mode("overwrite").json(f"{path}/summary")
    mermaid(edges).write.mode("overwrite").text(f"{path}/mermaid")
    graphml(nodes, edges).orderBy("place").select("value").write.mode("overwrite").text(f"{path}/graphml")
