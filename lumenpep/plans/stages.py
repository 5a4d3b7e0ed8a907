"""Stage tables that a rerun finds again: named by a hash of what they are made of, with a manifest that is written last."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What differs between two makings of one plan: ids of columns and objects, and numbers of lambdas' variables.
_ID = re.compile(r"#\d+L?|@[0-9a-f]+|\bplan_id=\d+|\[id=#?\d+\]|(?<=\blambda [xyz])_\d+")


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _nodes(plan) -> Iterator:
    """A plan's nodes, as the JVM's objects."""
    yield plan
    for one in (plan.children(), plan.innerChildren()):
        at = one.iterator()
        while at.hasNext():
            child = at.next()
            if "LogicalPlan" in {c.getSimpleName() for c in _classes(child)}:
                yield from _nodes(child)


def _classes(of) -> Iterator:
    c = of.getClass()
    while c is not None:
        yield c
        c = c.getSuperclass()


def _functions(expression) -> Iterator[int]:
    """Hashes of the pickled Python functions in an expression."""
    if expression.getClass().getSimpleName() == "PythonUDF":
        yield expression.func().command().hashCode()
    at = expression.children().iterator()
    while at.hasNext():
        yield from _functions(at.next())


def _unnamed(spark: SparkSession, plan) -> Iterator[tuple]:
    """What the text of a plan doesn't tell: rows that come from no file, by their number and a sum of hashes, and Python functions."""
    for node in _nodes(plan):
        kind = node.getClass().getSimpleName()
        if kind in ("LogicalRDD", "LocalRelation", "ExternalRDD"):
            rows = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, node), spark)
            cells = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rows.columns))))) if rows.columns else F.lit(0)
            yield kind, *rows.agg(F.count("*"), F.sum(cells.cast("decimal(38,0)"))).head()
        at = node.expressions().iterator()
        while at.hasNext():
            yield from (("function", h) for h in _functions(at.next()))


def fingerprint(df: DataFrame) -> str:
    """A hash of a table's plan, of the names, sizes and times of the files that it reads, of rows that the program made itself, which
    are read for it, and of Python functions as they are pickled. Equal hashes mean equal tables; a plan may get
    another hash where a function is pickled differently, and is then only made again."""
    spark = df.sparkSession
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", str(2**31 - 1))
    try:
        plan = df._jdf.queryExecution().analyzed()
        told = [_ID.sub("", plan.treeString()), *_unnamed(spark, plan)]
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
        fs, at = _fs(spark, folder)
        told += sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(at) if s.isFile())
    return hashlib.sha256(repr(told).encode()).hexdigest()


class Stages:
    """Tables in a folder that the driver and all executors share.

    table() gives a stage's table: the stored one where its manifest is there, else what make() gives, written and read
    again. The name holds a hash of the settings and of the tables it is made from, so another input, setting or plan
    is another table. A run that ends between two stages, or within one, leaves whole tables with a manifest and perhaps
    files of an attempt without one; the next run reads the former and makes the rest. Two runs at once write apart from each
    other; the first manifest counts.
    """

    def __init__(self, spark: SparkSession, folder: str, version: str = "1"):
        self.spark, self.folder, self.version = spark, folder.rstrip("/"), version
        self.keys: dict[str, str] = {}  # of each stage asked for: the hash its table is named by
        self.made: list[str] = []  # stages computed here, not found

    def _manifest(self, name: str, key: str) -> str:
        return f"{self.folder}/{name}-{key}/MANIFEST.json"

    def key(self, name: str, settings: object, inputs: list[DataFrame]) -> str:
        told = json.dumps([self.version, name, settings, [fingerprint(i) for i in inputs]], sort_keys=True, default=repr)
        return hashlib.sha256(told.encode()).hexdigest()[:32]

    def table(self, name: str, make: Callable[[], DataFrame], settings: object = None, inputs: list[DataFrame] | None = None) -> DataFrame:
        """inputs: the tables that make() reads; where None, those of the plan that it gives."""
        if not re.fullmatch(r"[A-Za-z0-9_.]+", name):
            raise ValueError(f"not a stage's name: {name}")
        made = make() if inputs is None else None
        key = self.keys[name] = self.key(name, settings, [made] if inputs is None else inputs)
        found = self._read(name, key)
        if found is None:
            data = f"{self.folder}/{name}-{key}/{uuid.uuid4().hex}"
            df = made if made is not None else make()
            df.write.parquet(data)
            self._finish(name, key, data, df)
            self.made.append(name)
            found = self._read(name, key)
        return found

    def _read(self, name: str, key: str) -> DataFrame | None:
        fs, at = _fs(self.spark, self._manifest(name, key))
        if not fs.exists(at):
            return None
        told = json.loads("\n".join(r[0] for r in self.spark.read.text(at.toString()).collect()))
        return self.spark.read.schema(told["schema"]).parquet(f"{self.folder}/{name}-{key}/{told['data']}")

    def _finish(self, name: str, key: str, data: str, df: DataFrame) -> None:
        """The manifest is whole as soon as it has its name; one that is there already stays."""
        told = json.dumps({"data": data.rsplit("/", 1)[1], "schema": df._jdf.schema().toDDL()})
        fs, at = _fs(self.spark, self._manifest(name, key))
        early = at.suffix(f".{uuid.uuid4().hex}")
        out = fs.create(early)
        out.write(told.encode("utf-8"))
        out.close()
        if not fs.exists(at):
            fs.rename(early, at)
        if fs.exists(early):
            fs.delete(early, False)

    def prune(self) -> list[str]:
        """Deletes older tables of the stages asked for in this run, and their own unfinished attempts; gives the names of
        folders deleted. Other stages' tables stay. Call it when no other run works in the folder."""
        fs, at = _fs(self.spark, self.folder)
        gone = []
        for s in fs.listStatus(at) if fs.exists(at) else []:
            name, _, key = s.getPath().getName().rpartition("-")
            if name in self.keys and re.fullmatch(r"[0-9a-f]{32}", key):
                if key != self.keys[name]:
                    fs.delete(s.getPath(), True)
                    gone.append(f"{name}-{key}")
                else:
                    self._drop_attempts(fs, name, key)
        return sorted(gone)

    def _drop_attempts(self, fs, name: str, key: str) -> None:
        manifest = _fs(self.spark, self._manifest(name, key))[1]
        if not fs.exists(manifest):
            return
        kept = json.loads("\n".join(r[0] for r in self.spark.read.text(manifest.toString()).collect()))["data"]
        for s in fs.listStatus(manifest.getParent()):
            if s.getPath().getName() not in (kept, "MANIFEST.json"):
                fs.delete(s.getPath(), True)
