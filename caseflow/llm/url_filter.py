"""URL rules in a sorted array of 64-bit digests.

A rule has a host, the beginning of a path and a verdict; it fits its host and all
subdomains where the path begins like that.  Of the rules that fit, the longest decides
(host and path together, then the host); a URL that none fits gets the default.

The rules become one file: the digests (xxhash64) of their full strings, sorted; beside
them the strings; and a second sorted array of host digests with the lengths of the
paths that the host's rules have.  Spark hands the file to every machine once, where workers
map it into memory and share its pages.  A batch of URLs is probed at once by binary search:
first the hosts' endings at dots, then, for hosts that have rules, the host with the
path cut to each length known there.  Equal digests are candidates only; the stored full string
decides, so colliding digests change nothing.

That holds up to ``MOST_BYTES`` of rules, whose size is measured before.  Larger rule tables
are joined with the same endings and path beginnings instead, by equality of the full strings.

Edge cases: a null URL, or one without ``://``, has an empty host and path, and the default;
rules without a host or verdict are ignored, a null path is an empty one; hosts compare with
A-Z lower-cased, paths as they are; of equal rules with different verdicts ``block`` holds;
repeated rows are judged each; an empty table gives no rows, and no rules the default.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from caseflow.llm import common as C
from caseflow.plans.spread import scratch_path

#: Rules held in one file, in bytes of their strings and digests.
MOST_BYTES = 1 << 30
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path up to a query or fragment."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def clean_rules(rules: DataFrame) -> DataFrame:
    """host, path, verdict; one row for a host and path."""
    known = rules.where(F.col("verdict").isNotNull() & (F.col("host") != ""))
    named = known.select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    return named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def digest(text: str, bits: int = 64) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> (64 - bits)


def digest_file(rules: list[tuple[str, str, str]], bits: int = 64) -> bytes:
    """The rules as one file; ``bits`` below 64 make digests collide."""
    full = [f"{h}\0{p}" for h, p, _ in rules]
    order = sorted(range(len(rules)), key=lambda i: (digest(full[i], bits), full[i]))
    text = [f"{full[i]}\0{rules[i][2]}".encode("utf-8", "replace") for i in order]
    lengths: dict[int, set[int]] = {}
    for h, p, _ in rules:
        lengths.setdefault(digest(h, bits), set()).add(len(p))
    hosts = sorted(lengths)
    parts = [
        np.array([digest(full[i], bits) for i in order], np.uint64),
        np.cumsum([0, *map(len, text)]).astype(np.uint64),
        np.array(hosts, np.uint64),
        np.cumsum([0, *[len(lengths[h]) for h in hosts]]).astype(np.uint64),
        np.array([n for h in hosts for n in sorted(lengths[h])], np.uint64),
    ]
    head = np.array([len(p) for p in parts] + [bits, max((len(h) for h, _, _ in rules), default=0)], np.uint64)
    return b"".join([head.tobytes(), *[p.tobytes() for p in parts], *text])


class DigestArray:
    """A mapped file of rules."""

    def __init__(self, path: str):
        size = os.path.getsize(path)
        raw = np.memmap(path, np.uint8, "r", shape=(size,))
        *sizes, self.bits, self.longest = (int(x) for x in raw[:56].view(np.uint64))
        at, parts = 56, []
        for n in sizes:
            parts.append(raw[at : at + 8 * n].view(np.uint64))
            at += 8 * n
        self.keys, self.places, self.hosts, self.firsts, self.lengths = parts
        self.text = raw[at:]

    def _digests(self, texts: list[str]) -> np.ndarray:
        return np.fromiter((digest(t, self.bits) for t in texts), np.uint64, len(texts))

    def _rule(self, i: int) -> tuple[str, str, str]:
        raw = self.text[int(self.places[i]) : int(self.places[i + 1])].tobytes()
        return tuple(raw.decode("utf-8").split("\0"))

    def path_lengths(self, hosts: list[str]) -> list[list[int]]:
        """For each host the path lengths of its rules (of others with its digest too)."""
        if not len(self.hosts):
            return [[] for _ in hosts]
        keys = self._digests(hosts)
        at = np.minimum(np.searchsorted(self.hosts, keys), len(self.hosts) - 1)
        met = self.hosts[at] == keys
        return [self.lengths[int(self.firsts[i]) : int(self.firsts[i + 1])].tolist() if m else [] for i, m in zip(at.tolist(), met.tolist())]

    def find(self, wanted: list[tuple[str, str]]) -> list[str | None]:
        """The verdict of the rule with exactly this host and path, or None."""
        keys = self._digests([f"{h}\0{p}" for h, p in wanted])
        low, high = (np.searchsorted(self.keys, keys, side=s).tolist() for s in ("left", "right"))
        found: list[str | None] = [None] * len(wanted)
        for n, (i, end) in enumerate(zip(low, high)):
            for k in range(i, end):  # more than one where digests collide
                host, path, verdict = self._rule(k)
                if (host, path) == wanted[n]:
                    found[n] = verdict
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """(rule, verdict) of the longest rule that fits, for each host and path."""
        tails = {h: host_endings(h, self.longest) for h in set(hosts)}
        every = sorted({t for x in tails.values() for t in x})
        lengths = dict(zip(every, self.path_lengths(every)))
        tried: dict[tuple[str, str], list[int]] = {}
        for i, (host, path) in enumerate(zip(hosts, paths)):
            for tail in tails[host]:
                for n in lengths[tail]:
                    if n <= len(path):
                        tried.setdefault((tail, path[:n]), []).append(i)
        best: list[tuple | None] = [None] * len(hosts)
        for (host, path), verdict in zip(tried, self.find(list(tried))):
            if verdict is not None:
                rank = (len(host) + len(path), len(host), host + path, verdict)
                for i in tried[host, path]:
                    if best[i] is None or rank > best[i]:
                        best[i] = rank
        return [b and b[2:] for b in best]


def host_endings(host: str, longest: int) -> list[str]:
    """The host and what follows each of its dots, up to a length."""
    found = [host] if 0 < len(host) <= longest else []
    at = host.find(".", max(0, len(host) - longest - 1))
    while at >= 0:
        if at + 1 < len(host):
            found.append(host[at + 1 :])
        at = host.find(".", at + 1)
    return found


def publish(spark: SparkSession, content: bytes) -> str:
    """Put a file into the shared folder and have Spark bring it to every machine; its name there."""
    path = scratch_path(spark, "url-rules") + ".bin"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(content))
    out.close()
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    keep: list[str],
    url_col: str = "url",
    default: str = DEFAULT,
    most_bytes: int = MOST_BYTES,
    bits: int = 64,
) -> DataFrame:
    """The columns of ``keep``, then host, path, rule (as host and path) and verdict.

    ``rules`` has columns host, path and verdict.
    """
    rules = clean_rules(rules)
    size = rules.agg(F.sum(F.length("host") + F.length("path") + F.length("verdict") + 32)).first()[0] or 0
    host, path = host_and_path(F.col(url_col))
    named = [F.col(k).alias(f"_keep{i}") for i, k in enumerate(keep)]
    parts = pages.select(*named, host.alias("host"), path.alias("path"))
    judged = _by_array(parts, rules, bits) if size <= most_bytes else _by_join(parts, rules)
    back = [F.col(f"_keep{i}").alias(k) for i, k in enumerate(keep)]
    return judged.select(*back, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _by_array(parts: DataFrame, rules: DataFrame, bits: int) -> DataFrame:
    listed = [(r["host"], r["path"], r["verdict"]) for r in rules.toArrow().to_pylist()]
    name = publish(parts.sparkSession, digest_file(listed, bits))
    fields = [*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
    names = [f.name for f in fields]
    at_host, at_path = names.index("host"), names.index("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for b in batches:
            got = array.judge(b.column(at_host).to_pylist(), b.column(at_path).to_pylist())
            made = [pa.array([g and g[k] for g in got], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=names)

    return parts.mapInArrow(run, T.StructType(fields))


def _by_join(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by joins, for rules of any size: host endings meet hosts that have rules, and
    with the path cut to the lengths known there meet the rules.  Endings and paths that
    many URLs share are probed once."""
    parts = C.stored(parts, "url-parts")
    longest = rules.agg(F.max(F.length("host"))).first()[0] or 0
    host = F.col("host")
    labels = F.split(host, r"\.")
    n = F.size(labels)
    ending = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    hosts = parts.select("host").distinct().withColumn("tail", F.explode(ending)).where(F.length("tail").between(1, longest))
    lengths = rules.select(F.col("host").alias("tail"), F.length("path").alias("n")).distinct()
    known = hosts.join(lengths, "tail")
    asked = parts.select("host", "path").distinct().join(known, "host").where(F.length("path") >= F.col("n"))
    asked = asked.select("host", "path", "tail", F.substring("path", F.lit(1), F.col("n")).alias("head"))
    met = asked.join(rules.select(F.col("host").alias("tail"), F.col("path").alias("head"), "verdict"), ["tail", "head"])
    rank = F.struct((F.length("tail") + F.length("head")).alias("n"), F.length("tail").alias("m"), "tail", "head", "verdict")
    best = met.groupBy("host", "path").agg(F.max(rank).alias("b"))
    best = best.select("host", "path", F.concat("b.tail", "b.head").alias("rule"), "b.verdict")
    return parts.join(best, ["host", "path"], "left")
