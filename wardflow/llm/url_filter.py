"""URL filters: rules in a sorted digest array, which every task maps into memory.

A rule is ``host/path``: it fits the urls of that host and its subdomains whose path starts with the rule's path; of
the rules that fit, the longest decides.  Rules are stored as sorted 64-bit xxhash digests with their full strings.  A
batch of urls is probed by binary search over the mapped digests, all candidates at once; an equal digest counts only
if the stored string is equal too, so colliding digests cannot change a verdict.

Two arrays keep the candidates few: one of the rules' hosts, with the path lengths in use below each, and one of the
whole rules.  A url probes the suffixes of its host, then only the path lengths of the hosts that were found.

The arrays are flat files in the shared folder; Spark fetches them to every executor once, and again to new executors.
A rule table above ``list_bytes`` is not sent to the executors but joined with the candidates of the urls.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, tune, work_folder, written

# The seed of Spark's own xxhash64, so that the JVM digests the rules and Python the urls.
SEED = 42
# Rule tables up to this size are stored as arrays (they pass the driver once, and lie on every executor's disk).
LIST_BYTES = 256 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_table(spark: SparkSession, rules: DataFrame | Iterable[tuple[str, str]]) -> DataFrame:
    """``rule, verdict, host, path`` of each different rule: hosts lower-cased, a rule listed as both is ``block``.

    Rules that are null, have no host, or have another verdict than ``allow`` or ``block`` are ignored.
    """
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "rule string, verdict string")
    host = F.translate(F.regexp_extract("rule", r"^[^/]*", 0), _UPPER, _LOWER)
    parts = rules.select(column("rule").alias("rule"), column("verdict").alias("verdict")).where("rule is not null and verdict in ('allow', 'block')")
    parts = parts.select("verdict", host.alias("host"), F.regexp_extract("rule", r"^[^/]*(.*)", 1).alias("path")).where("host <> ''")
    return parts.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(F.concat("host", "path").alias("rule"), "verdict", "host", "path")


class DigestArray:
    """Strings and a value of each, in a flat file: their number, digests in order, ends of strings and values, all bytes."""

    def __init__(self, path: str, bits: int = 64) -> None:
        n = int(np.fromfile(path, np.int64, 1)[0])
        self.mask = (1 << bits) - 1
        head = np.memmap(path, np.int64, "r", 8, (3 * n + 1,))
        self.keys, self.ends = head[:n], head[n:]
        self.bytes = np.memmap(path, np.uint8, "r", 8 * (3 * n + 2)) if n else np.empty(0, np.uint8)

    def text(self, entry: int) -> bytes:
        return self.bytes[self.ends[2 * entry] : self.ends[2 * entry + 1]].tobytes()

    def value(self, entry: int) -> bytes:
        return self.bytes[self.ends[2 * entry + 1] : self.ends[2 * entry + 2]].tobytes()

    def find(self, strings: list[bytes]) -> np.ndarray:
        """The entry of each string, -1 where it is not listed: one binary search for all, then the stored strings."""
        found = np.full(len(strings), -1, np.int64)
        wanted = np.fromiter((xxhash.xxh64_intdigest(s, SEED) & self.mask for s in strings), np.uint64, len(strings)).view(np.int64)
        at, left = np.searchsorted(self.keys, wanted), np.arange(len(strings))
        while len(left):
            left = left[at[left] < len(self.keys)]
            left = left[self.keys[at[left]] == wanted[left]]
            same = np.fromiter((self.text(at[i]) == strings[i] for i in left), bool, len(left))
            found[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1  # another string with the same digest
        return found


def store_array(rows: DataFrame, name: str, bits: int = 64) -> str:
    """Writes ``text, value`` as a ``DigestArray`` to the shared folder, from where Spark fetches it to every executor.

    Spark sorts the rows by their digests; the caller bounds their size, as they pass the driver.
    """
    spark = rows.sparkSession
    digest = F.xxhash64("text")
    rows = rows.withColumn("digest", digest if bits == 64 else digest.bitwiseAND(F.lit((1 << bits) - 1)))
    digests, parts = [], []
    for row in rows.orderBy("digest", "text").toLocalIterator():
        digests.append(row["digest"])
        parts += [row["text"].encode(), row["value"].encode()]
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int64)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}.bin")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        for part in (np.array([len(digests)], np.int64).tobytes(), np.array(digests, np.int64).tobytes(), ends.tobytes(), b"".join(parts)):
            for i in range(0, len(part), 1 << 20):
                out.write(bytearray(part[i : i + (1 << 20)]))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return path.getName()


def _suffixes(host: str, longest: int) -> list[str]:
    """The host and its parent domains, as far as some rule's host is that long."""
    out, at = [], max(0, len(host) - longest)
    if at:  # a longer suffix cannot be listed
        at = host.find(".", at - 1) + 1
        if not at:
            return out
    while True:
        out.append(host[at:])
        at = host.find(".", at) + 1
        if not at:
            return out


def _longest(found: list[tuple[str, str, str]]) -> tuple:
    """Of rules ``(host, path, verdict)`` that fit one url the longest, and of equally long ones that of the longest host."""
    host, path, verdict = max(found, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])))
    return host + path, verdict


def _probe(hosts_file: str, rules_file: str, longest: int, bits: int):
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        # Opened once per task; the maps of all tasks on a machine share its page cache.
        host_array, rule_array = (DigestArray(SparkFiles.get(f), bits) for f in (hosts_file, rules_file))
        for hosts, paths in batches:
            suffixes = [(name, s) for name in set(hosts) for s in _suffixes(name, longest)]
            listed: dict[str, list] = {}
            for (name, suffix), entry in zip(suffixes, host_array.find([s.encode() for _, s in suffixes]).tolist()):
                if entry >= 0:
                    listed.setdefault(name, []).append((suffix, [int(n) for n in host_array.value(entry).split(b",")]))
            probes = [(i, suffix, path[:n]) for i, (name, path) in enumerate(zip(hosts, paths)) for suffix, sizes in listed.get(name, ()) for n in sizes if n <= len(path)]
            fits: dict[int, list] = {}
            for (i, host, path), entry in zip(probes, rule_array.find([(h + p).encode() for _, h, p in probes]).tolist()):
                if entry >= 0:
                    fits.setdefault(i, []).append((host, path, rule_array.value(entry).decode()))
            out = [_longest(fits[i]) if i in fits else (None, None) for i in range(len(hosts))]
            yield pd.DataFrame(out, columns=["rule", "verdict"], dtype=object)

    return run


def _joined(df: DataFrame, rules: DataFrame, longest: int) -> DataFrame:
    """As the digest arrays give it, with joins: for rule tables too large for every executor's disk."""
    parents = F.udf(lambda host: _suffixes(host, longest), "array<string>")
    urls = written(df.withColumn("__row", F.monotonically_increasing_id()), "urls")
    sizes = rules.groupBy(F.col("host").alias("__suffix")).agg(F.collect_set(F.length("path")).alias("__sizes"))
    suffixes = urls.select("__host").distinct().withColumn("__suffix", F.explode(parents("__host"))).join(sizes, "__suffix")
    probes = urls.select("__row", "__host", "__path").join(suffixes, "__host").withColumn("__n", F.explode("__sizes")).where("__n <= length(__path)")
    probes = probes.select("__row", F.col("__suffix").alias("host"), F.expr("substring(__path, 1, __n)").alias("path"))
    size = F.struct(F.length("rule"), F.length("host"), "rule", "verdict")
    best = probes.join(rules, ["host", "path"]).groupBy("__row").agg(F.max(size).alias("__best"))
    return urls.join(best.select("__row", F.col("__best.rule").alias("__rule"), F.col("__best.verdict").alias("__verdict")), "__row", "left").drop("__row")


def filter_urls(df: DataFrame, rules: DataFrame | Iterable[tuple[str, str]], url_col: str = "url", otherwise: str = "allow", list_bytes: int = LIST_BYTES, bits: int = 64) -> DataFrame:
    """``df`` with ``host, path, rule, verdict``: the longest rule that fits each url, and its verdict.

    Hosts are compared with A-Z lower-cased, paths as they are.  A url that no rule fits gets a null rule and the verdict
    ``otherwise``; so do null urls, empty ones and those without ``://``, whose host and path are empty.  Repeated urls
    and rows get the same verdict each.  Without rules every url gets ``otherwise``.  Columns of ``df`` that have one of
    the four names are replaced, others stay.  ``bits`` shortens the digests (tests of collisions).
    """
    spark = df.sparkSession
    tune(spark)
    rules = written(rule_table(spark, rules), "rules")
    stored = rules.agg(F.coalesce(F.sum(F.octet_length("rule") + 64), F.lit(0)).alias("bytes"), F.coalesce(F.max(F.length("host")), F.lit(0)).alias("longest")).first()
    parsed = df.withColumns({"__host": host_of(column(url_col)), "__path": path_of(column(url_col))})
    if stored.bytes > list_bytes:
        judged = _joined(parsed, rules, stored.longest)
    else:
        sizes = rules.groupBy(F.col("host").alias("text")).agg(F.concat_ws(",", F.collect_set(F.length("path").cast("string"))).alias("value"))
        files = store_array(sizes, "url-hosts", bits), store_array(rules.select(F.col("rule").alias("text"), F.col("verdict").alias("value")), "url-rules", bits)
        found = F.pandas_udf(_probe(*files, stored.longest, bits), "rule string, verdict string").asNondeterministic()(F.col("__host"), F.col("__path"))
        judged = parsed.withColumn("__found", found).withColumns({"__rule": F.col("__found.rule"), "__verdict": F.col("__found.verdict")}).drop("__found")
    given = {"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__rule"), "verdict": F.coalesce("__verdict", F.lit(otherwise))}
    return judged.withColumns(given).drop("__host", "__path", "__rule", "__verdict")


def judge_urls(df: DataFrame, rules: DataFrame | Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", **options) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row; only the two columns named are read."""
    pages = df.select(column(id_col).alias("page_id"), column(url_col).alias("url"))
    return filter_urls(pages, rules, "url", **options).select("page_id", "host", "path", "rule", "verdict")
