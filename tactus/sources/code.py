"""Python sources as graph nodes and edges; a file is parsed on its own, so files spread over tasks."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders that are not a project's own.
SKIPPED = (".git", ".venv", "venv", "__pycache__", "node_modules", "build", "dist")
_OUT = "kind string, source string, target string, type string, name string, file string, lineno int, detail string"


def _walk(path: str, text: str) -> Iterator[tuple]:
    module = path.rsplit("/", 1)[-1].removesuffix(".py")
    yield "node", f"module:{module}", None, "module", module, path, 1, ""
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError) as e:
        yield "error", f"module:{module}", None, "error", module, path, 1, str(e)
        return

    def visit(node: ast.AST, owner: str, klass: str | None) -> Iterator[tuple]:
        for x in ast.iter_child_nodes(node):
            if isinstance(x, ast.ClassDef | ast.FunctionDef | ast.AsyncFunctionDef):
                kind = "class" if isinstance(x, ast.ClassDef) else "method" if klass else "function"
                own = f"{kind}:{module}.{klass + '.' if klass else ''}{x.name}"
                yield "node", own, None, kind, x.name, path, x.lineno, ast.get_docstring(x) or ""
                yield "edge", owner, own, "CONTAINS", x.name, path, x.lineno, ""
                if kind == "class":
                    for b in x.bases:
                        yield "edge", own, f"ref:{ast.unparse(b)}", "INHERITS", x.name, path, x.lineno, ""
                yield from visit(x, own, x.name if kind == "class" else klass)
            elif isinstance(x, ast.Import | ast.ImportFrom):
                names = [a.name for a in x.names] if isinstance(x, ast.Import) else [x.module or "."]
                for n in names:
                    yield "edge", f"module:{module}", f"import:{n}", "IMPORTS", n, path, x.lineno, ""
            else:
                if isinstance(x, ast.Call):
                    yield "edge", owner, f"ref:{ast.unparse(x.func)}", "CALLS", ast.unparse(x.func), path, x.lineno, klass or ""
                yield from visit(x, owner, klass)

    yield from visit(tree, f"module:{module}", None)


def scan(files: DataFrame) -> DataFrame:
    """Node, edge and error rows of (path, value) rows."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [r for p, t in zip(pdf["path"], pdf["value"], strict=True) for r in _walk(p, t or "")]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])

    return files.select("path", "value").mapInPandas(run, _OUT)


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """path, value of the project's own Python files."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.py").text(path, wholetext=True).withColumn("path", F.input_file_name())
    return files.where(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, SKIPPED))))


def dependencies(spark: SparkSession, toml_text: str) -> DataFrame:
    """The distinct names of a project file's dependencies, without versions and markers, in order."""
    import tomllib

    project = tomllib.loads(toml_text).get("project", {})
    listed = [*project.get("dependencies", []), *(d for group in project.get("optional-dependencies", {}).values() for d in group)]
    rows = spark.createDataFrame([(x,) for x in listed], "spec string")
    return rows.select(F.regexp_extract("spec", r"^\s*([A-Za-z0-9._-]+)", 1).alias("name")).distinct().orderBy("name")
