"""What several operators share: words as bytes, Arrow mapping, scratch tables, folds of documents."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that a Python worker turns into objects at once. The session's own settings bound an Arrow batch by rows and bytes; a task cuts it further.
BATCH_ROWS = 500
# Byte map of the alphanumeric words: A-Z to a-z, every other ASCII byte that is no letter or digit to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
# Java form of what stands between such words, and of one word.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SHIPPED: set[str] = set()
WHITE = " \t\n\x0b\f\r"


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(WORD_BYTES).split()


def plain_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``; bytes.split() splits at just these characters."""
    return text.split()


def shipped(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once a session, so that tasks import it and keep its module caches."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in [package / "__init__.py", *sorted((package / "llm").glob("*.py"))]:
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def pieces(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows, without a copy."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mapped(df: DataFrame, rows: Callable[[], Callable[[dict], list[tuple]]], schema: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Apply a function of column lists to pieces of at most ``batch_rows`` rows.

    ``rows`` is called once in each task and returns the function; that gets a piece as
    a dict of lists and returns output rows. Nothing outlives a task but module caches.
    """
    shipped(df.sparkSession)
    names = [field.split()[0] for field in _fields(schema)]
    types = _arrow_types(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = rows()
        for batch in pieces(batches, batch_rows):
            out = apply({n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns, strict=True)})
            columns = list(zip(*out, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return df.mapInArrow(run, schema)


def _fields(schema: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return out


def _arrow_types(schema: str) -> list[pa.DataType]:
    known = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
             "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()),
             "array<struct<start:int,end:int>>": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
             "array<struct<kind:string,start:int,end:int>>":
                 pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))}
    return [known[field.split(None, 1)[1]] for field in _fields(schema)]


def every(df: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many more underscores as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """mapInArrow() of a function that keeps all columns; those whose names hold a dot or a backtick have others meanwhile."""
    plain = df.toDF(*(free_name(df, f"_c{i}") if "." in c or "`" in c else c for i, c in enumerate(df.columns)))
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def texts(df: DataFrame, *others: str, column: str = "text") -> DataFrame:
    """The named columns and the whole text, null as empty; nothing else is read or clashes."""
    return df.select(*others, F.coalesce(F.col(column), F.lit("")).alias("text"))


def byte_texts(df: DataFrame, *others: str, column: str = "text") -> DataFrame:
    """Like texts(), as UTF-8 bytes."""
    return df.select(*others, F.coalesce(F.col(column), F.lit("")).cast("binary").alias("text"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids are in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once as Parquet in the cluster's shared folder and read them from there.

    The folder is spark.checkpoint.dir; without it a local session takes a temporary
    folder, and a cluster gets an error rather than files that executors cannot share.
    """
    spark = df.sparkSession
    path = f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _shared(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="ledgerloom-llm-")
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    return f"file://{folder}"
