"""URL blocklists as memory-mapped sorted arrays of 64-bit digests.

The list's entries are ``host`` (it and its subdomains) or ``host/path`` (that
path and what is under it). ``build`` range-partitions their xxhash64 keys; each
task writes its keys in sorted order, with the entries themselves, as one shard
in the shared folder, and the driver gets the shards' bounds alone. Spark
hands the files to executors, which map them into memory. A URL's candidates (its
host, parent domains, and its path's prefixes) are hashed by native columns,
probed by vectorised binary search in the shard of their range, and a hit counts only if the stored entry
is the candidate, so digest collisions cannot block a URL.

A shard is 8 + 8 bytes an entry besides the entries, and pages into memory as
it is probed; nothing is broadcast.

Defined results: null, empty and hostless URLs are not blocked. What stands
before a colon is a host, not a scheme, if only digits follow up to the path (the
SQL of the query takes it for a scheme). An entry of one label blocks all below it. Host case,
ports, user names and a trailing dot don't matter; query and fragment neither;
path case does. A null or blank entry is left out, repeated ones count once.
Of several entries that block a URL, the one with the shortest host comes
first, then the shortest path. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import free
from .scratch import shared_dir
from .textcore import flat

#: The project's own list, of hosts and of paths on hosts that are not blocked as a whole.
BLOCKLIST = tuple(f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")) + tuple(
    f"{host}/{path}" for host in ("blog.tionsh.example.net", "thther.example.org", "www.ththhe.example.com", "m.ththth.example.net", "blog.ththan.example.net") for path in ("en", "de/49", "es/2")
)

_MAGIC = b"MGDA0001"
_URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:(?![0-9]+(?:[/?#\s]|$)))?(?://)?(?:[^/?#@]*@)?([^/:?#\s]*)(?::[0-9]*)?([^?#\s]*)"


def host(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, _URL, 1)), F.lit("."))


def path(url: Column) -> Column:
    """Without a slash at the end."""
    return F.rtrim(F.regexp_extract(url, _URL, 2), F.lit("/"))


def candidates(url: Column) -> Column:
    """array<string>: entries that would block the URL, domains from the shortest on, then paths from the shortest on."""
    labels = F.split(host(url), r"\.", -1)
    n = F.size(labels)
    hosts = F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    steps = F.split(path(url), "/", -1)
    paths = F.when(F.size(steps) > 1, F.transform(F.sequence(F.lit(2), F.size(steps)), lambda k: F.concat(host(url), F.array_join(F.slice(steps, F.lit(1), k), "/"))))
    return F.when(host(url) != "", F.concat(hosts, F.coalesce(paths, F.array().cast("array<string>"))))


#: Of each shard its least and greatest key and the name of its file.
Shards = tuple[tuple[int, int, str], ...]


def build(spark: SparkSession, entries: Iterable[str | None] | DataFrame) -> Shards:
    """The index, for ``blocked``. Of a DataFrame the first column is read."""
    if not isinstance(entries, DataFrame):
        entries = spark.createDataFrame([(e,) for e in entries], "entry string")
    raw = F.trim(F.col(f"`{entries.columns[0]}`").cast("string"))
    entry = F.concat(host(raw), path(raw))
    folder = f"{shared_dir(spark)}/digests-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        keys = np.concatenate([b.column("key").to_numpy() for b in parts])
        raw = [flat(b.column("entry")) for b in parts]
        ends = np.cumsum(np.concatenate([np.diff(at) for _, at in raw]))
        task = TaskContext.get()
        name = f"digests-{uuid.uuid4().hex}-{task.partitionId()}.bin"
        fs, at = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(at, recursive=True)
        with fs.open_output_stream(f"{at}/{name}") as out:
            for piece in (_MAGIC, np.int64(len(keys)).tobytes(), keys.astype("<i8").tobytes(), ends.astype("<i8").tobytes(), *(d.tobytes() for d, _ in raw)):
                out.write(piece)
        yield pa.RecordBatch.from_arrays([pa.array([int(keys[0])]), pa.array([int(keys[-1])]), pa.array([name])], ["least", "greatest", "name"])

    rows = entries.select(entry.alias("entry")).where("entry != ''").distinct().select(F.xxhash64("entry").alias("key"), "entry")
    shards = rows.repartitionByRange("key").sortWithinPartitions("key", "entry").mapInArrow(write, "least long, greatest long, name string").collect()
    for s in shards:
        spark.sparkContext.addFile(f"{folder}/{s.name}")
    return tuple(sorted(tuple(s) for s in shards))


class Index:
    """The mapped file."""

    def __init__(self, file: str):
        head = np.memmap(file, np.uint8, "r")
        if head[:8].tobytes() != _MAGIC:
            raise ValueError("not a digest index")
        self.n = n = int(head[8:16].view("<i8")[0])
        self.keys = head[16 : 16 + 8 * n].view("<i8")
        self.ends = head[16 + 8 * n : 16 + 16 * n].view("<i8")
        self.texts = head[16 + 16 * n :]

    def entry(self, i: int) -> bytes:
        return self.texts[(self.ends[i - 1] if i else 0) : self.ends[i]].tobytes()

    def probe(self, keys: np.ndarray, text_of) -> np.ndarray:
        """Places, among the keys, of those whose own string is stored; text_of(place) gives the string's bytes."""
        if not self.n:
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.keys, keys)
        hits = np.flatnonzero(self.keys[np.minimum(at, self.n - 1)] == keys)
        good = []
        for h in hits.tolist():
            i, want = int(at[h]), text_of(h)
            while i < self.n and self.keys[i] == keys[h]:
                if self.entry(i) == want:
                    good.append(h)
                    break
                i += 1
        return np.array(good, np.int64)


_open: dict[str, Index] = {}


def _shard(name: str) -> Index:
    if name not in _open:
        _open[name] = Index(SparkFiles.get(name))
    return _open[name]


def blocked(pages: DataFrame, index: Shards, url_col: str = "url") -> DataFrame:
    """All columns, and blocked and entry (the one that blocks, or null) in place of columns of that name."""

    @F.arrow_udf("int")
    def first(texts: pa.Array, keys: pa.Array) -> pa.Array:
        flat_texts, flat_keys = texts.flatten(), keys.flatten().to_numpy()
        counts = pa.compute.fill_null(pa.compute.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(texts)), counts)
        good = [np.zeros(0, np.int64)]
        for least, greatest, name in index:
            mine = np.flatnonzero((flat_keys >= least) & (flat_keys <= greatest))
            if len(mine):
                good.append(mine[_shard(name).probe(flat_keys[mine], lambda i, mine=mine: flat_texts[int(mine[i])].as_py().encode())])
        good = np.sort(np.concatenate(good))
        out = np.full(len(texts), -1, np.int32)
        begin = np.cumsum(counts) - counts
        rows, at = np.unique(row[good], return_index=True)
        out[rows] = good[at] - begin[rows]
        return pa.array(out)

    names = [c for c in pages.columns if c not in ("blocked", "entry")]
    every, keys, at = (free(pages, f"_uf_{x}") for x in ("all", "keys", "at"))
    rows = pages.withColumn(every, candidates(F.col(f"`{url_col}`"))).withColumn(keys, F.transform(every, lambda x: F.xxhash64(x)))
    rows = rows.withColumn(at, first(every, keys))
    return rows.select(*[f"`{c}`" for c in names], (F.col(at) >= 0).alias("blocked"), F.when(F.col(at) >= 0, F.get(every, at)).alias("entry"))
