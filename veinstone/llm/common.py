"""What several operators of this subpackage share: tables, shared storage, Arrow chunks, words."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: U+0020 and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares. Where none is set, a local master gets one of this machine; a cluster has none to fall back on."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='veinstone-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/veinstone-{name}-{uuid.uuid4().hex[:12]}"


def until_exit(spark: SparkSession, path: str) -> None:
    """What is written at path goes when the driver ends, if it was not removed sooner."""
    folder, files = _folder(spark, path)
    files.deleteOnExit(folder)


def _folder(spark: SparkSession, path: str) -> tuple:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


#: The folders of written tables.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends here, and a lost executor loses nothing of it.

    The files of the shuffles behind it, which nothing reads again, are freed at once.
    """
    spark, free = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, was = new_folder(spark, name), spark.conf.get(free, None)
    spark.conf.set(free, "true")
    try:
        df.write.option("compression", "zstd").options(**options).parquet(path)
    finally:
        spark.conf.unset(free) if was is None else spark.conf.set(free, was)
    until_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


def written_by(df: DataFrame, by: str, name: str) -> DataFrame:
    """The same with a folder for each value of the column by, of which there are at most 8, so that `discard_part` can delete some rows and leave others."""
    spark, writers = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    path, was = new_folder(spark, name), spark.conf.get(writers, None)
    spark.conf.set(writers, "8")  # rows go to their files as they come, without a sort
    try:
        df.write.partitionBy(by).option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    finally:
        spark.conf.unset(writers) if was is None else spark.conf.set(writers, was)
    until_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


def discard_part(table: DataFrame, folder: str) -> None:
    """Deletes one of the folders of a table that `written_by` wrote."""
    remove(table.sparkSession, f"{_folders[table]}/{folder}")


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read again: all that was made of them is written itself."""
    for t in tables:
        remove(t.sparkSession, _folders.pop(t))


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def bind(value: Column, body) -> Column:
    """body(value) with value evaluated once, whatever the optimiser inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def crc_mod(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo modulus."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus))


def chunks(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = 8 << 20, max_rows: int = 4096) -> Iterator[pa.Table]:
    """The rows of batches in tables of at most max_bytes of text (or one row) and max_rows rows."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float)) + 64
        ends, start = np.cumsum(sizes), 0
        while start < n:
            base = ends[start - 1] if start else 0.0
            stop = min(max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right"))), start + max_rows, n)
            yield pa.Table.from_batches([batch.slice(start, stop - start)])
            start = stop


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], max_bytes: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by keys (numbers) in tables of whole groups, of about max_bytes or one group, with the groups' first places and the end."""

    def starts(table: pa.Table) -> np.ndarray:
        new = np.ones(table.num_rows, bool)
        new[1:] = False
        for k in keys:
            own = table.column(k).to_numpy()
            new[1:] |= own[1:] != own[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    held: list[pa.RecordBatch] = []
    size, full = 0, max_bytes
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= full:
            table = pa.Table.from_batches(held).combine_chunks()
            at = starts(table)
            if len(at) > 2:  # the last group may go on
                yield table.slice(0, at[-2]), at[:-1]
                held = table.slice(at[-2]).to_batches()
                size = sum(b.nbytes for b in held)
            full = max(max_bytes, 2 * size)
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(table)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A column name for each of names that df does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while (name := f"__{name}").lower() in taken:
            pass
        out.append(name)
    return out


def column(rows: pa.Table, name: str) -> pa.Array:
    col = rows.column(name).combine_chunks()
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def texts_of(rows: pa.Table, name: str) -> pa.Array:
    """A column's texts, null as empty."""
    return pc.fill_null(column(rows, name), "")


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For texts without nulls: each word's code, each text's first position among the words (one more than texts), and the distinct words by code."""
    parts = pc.ascii_split_whitespace(texts)
    ends = parts.offsets.to_numpy().astype(np.int64)
    values = parts.values.slice(ends[0], ends[-1] - ends[0])
    ends = ends - ends[0]
    coded = values.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    empty = pc.index(distinct, "").as_py()
    if empty >= 0:
        full = codes != empty
        return codes[full], ends - np.searchsorted(np.flatnonzero(~full), ends), distinct
    return codes, ends, distinct


def hash_strings(values: pa.Array, key: str = "veinstone-words-") -> np.ndarray:
    """A 64-bit hash of each string, the same in every process."""
    import pandas as pd

    own = lambda x: pd.util.hash_array(x.to_numpy(zero_copy_only=False).astype(object), hash_key=key[:16].ljust(16, "0"), categorize=False)
    return np.concatenate([own(values.slice(at, 1 << 16)) for at in range(0, max(len(values), 1), 1 << 16)])


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(bits: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1) from 64 random bits."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
