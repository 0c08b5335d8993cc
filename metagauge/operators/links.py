"""Checks and downloads of linked files. Network access is a client that callers may replace."""

from __future__ import annotations

import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metagauge.functions.expr import base_name, col
from metagauge.sources.files import file_system

CHUNK = 8192
#: Seconds that a connection may keep silent, and requests that a task has under way.
TIMEOUT, THREADS = 10.0, 16


def _open(url: str, method: str, timeout: float):
    """Only http and https: a file link would read the worker's own disk."""
    if urlsplit(url).scheme.lower() not in ("http", "https"):
        raise ValueError("neither http nor https")
    return urllib.request.urlopen(urllib.request.Request(url, method=method), timeout=timeout)


def http_status(url: str, timeout: float = TIMEOUT) -> str:
    """Status code of a HEAD request, redirects followed, or "Error: ..."."""
    try:
        with _open(url, "HEAD", timeout) as r:
            return str(r.status)
    except urllib.error.HTTPError as e:
        return str(e.code)
    except Exception as e:  # the outcome of a probe is data
        return f"Error: {e}"


def http_get(url: str, timeout: float = TIMEOUT) -> Iterator[bytes]:
    """The body in chunks."""
    with _open(url, "GET", timeout) as r:
        while chunk := r.read(CHUNK):
            yield chunk


def links(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, url): a row for each link that isn't null."""
    columns = list(columns)
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("url")) for c in columns])).alias("l"))
    return rows.select("l.*").where("url is not null")


def _spread(df: DataFrame, key: str, parallel: int | None) -> DataFrame:
    """In as many partitions as asked for, or else as the session has for shuffles: requests take time, not bytes, so these aren't put together."""
    return df.repartition(parallel or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def link_status(urls: DataFrame, client: Callable[[str], str] = http_status, parallel: int | None = None, threads: int = THREADS) -> DataFrame:
    """All columns of urls and status. Each distinct url is probed once, some at a time in each task; a null one has a null status."""

    def probe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for part in parts:
                yield part.assign(status=list(map(str, pool.map(client, part["url"]))))

    found = _spread(urls.select("url").where("url is not null").distinct(), "url", parallel).mapInPandas(probe, "url string, status string")
    return urls.join(found, "url", "left")


def status_histogram(statuses: DataFrame) -> DataFrame:
    """(status, count); links without a status are left out."""
    return statuses.where("status is not null").groupBy("status").agg(F.count(F.lit(1)).alias("count"))


def file_name(url: Column, index: Column) -> Column:
    return base_name(url, F.concat(F.lit("downloaded_file_"), index.cast("string")))


def safe_name(url: Column, index: Column) -> Column:
    """file_name, but of names that aren't those of a file in a folder (., .., with a separator or a control character) what is left after these are taken out, behind the index."""
    name = file_name(url, index)
    odd = name.isin(".", "..") | name.rlike(r"[/\\\\\x00-\x1f]")
    return F.when(odd, F.concat(index.cast("string"), F.lit("_"), F.regexp_replace(name, r"[/\\\\\x00-\x1f]|^\.+", ""))).otherwise(name)


def download(df: DataFrame, link_col: str, index_col: str, folder: str, client: Callable[[str], Iterable[bytes]] = http_get, parallel: int | None = None, threads: int = THREADS) -> DataFrame:
    """(index, url, filename, status, bytes, error) of each row: downloaded, or failed and why.

    folder, a path or a URI, is one that all executors share. Of rows with the same file name the one with the least index keeps
    it; the others have their own index put before it, as often as it takes for a name that no row has by itself.
    """
    rows = df.select(col(index_col).cast("long").alias("index"), col(link_col).cast("string").alias("url"))
    rows = rows.withColumn("own", safe_name(F.coalesce("url", F.lit("")), F.col("index")))
    first = rows.groupBy("own").agg(F.min("index").alias("first"))
    rows = rows.join(first, "own")
    prefixed = lambda n: F.concat(*[F.concat(F.col("index").cast("string"), F.lit("_"))] * n, F.col("own"))
    free = rows.withColumn("filename", F.when(F.col("index").eqNullSafe(F.col("first")), F.col("own")).otherwise(prefixed(1)))
    taken = first.select(F.col("own").alias("filename"), F.lit(True).alias("taken"))
    # A name with the index before it may be another row's own: then twice the index is put before it, which holds a name that no own one can be short of.
    rows = free.join(taken, "filename", "left").withColumn("filename", F.when(F.col("index").eqNullSafe(F.col("first")) | F.col("taken").isNull(), F.col("filename")).otherwise(F.concat(F.lit("_"), prefixed(2))))

    def fetch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, at = file_system(folder)
        attempt = TaskContext.get().taskAttemptId()

        def one(row: tuple) -> tuple:
            index, url, name = row
            size, error = 0, None
            part = f"{at}/.part-{attempt}-{index}"
            try:
                if url is None:
                    raise ValueError("no link")
                with fs.open_output_stream(part) as f:
                    for chunk in client(url):
                        f.write(chunk)
                        size += len(chunk)
                fs.move(part, f"{at}/{name}")
            except Exception as e:  # one row's failure is its result
                error = str(e)
                try:
                    fs.delete_file(part)
                except OSError:
                    pass
            return index, url, name, "failed" if error is not None else "downloaded", size, error

        with ThreadPoolExecutor(threads) as pool:
            for part in parts:
                yield pd.DataFrame(list(pool.map(one, part.itertuples(index=False))), columns=["index", "url", "filename", "status", "bytes", "error"])

    return _spread(rows.select("index", "url", "filename"), "index", parallel).mapInPandas(fetch, "index long, url string, filename string, status string, bytes long, error string")
