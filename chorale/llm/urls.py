"""URL filters: rules in a sorted array of 64-bit digests.

A rule is a host and a start of the path, blocked or allowed. The digests of all rules stand sorted in one file next
to the rules' full strings. Every executor maps the file into memory. For a batch of URLs all strings that a rule
could have (the host and each domain above it, joined with the path cut to every length that rules have) are hashed,
looked up in one vectorised binary search, and each hit is confirmed against the stored string. The longest confirmed
rule decides.

The file is sent along with the job by Spark, so its size is checked: beyond ``MAX_BYTES`` the rules are dealt into
several files by digest and the URLs run past them one file after the other.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import small_batches, unclashed

#: Bytes of one digest file. What a URL gets when no rule fits.
MAX_BYTES, DEFAULT = 256 * 1024 * 1024, "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case and path; both empty where the URL is null or has no ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class DigestArray:
    """A memory-mapped file: number of rules, digests ascending, ends of the strings, strings, verdicts."""

    def __init__(self, path: str) -> None:
        data = np.memmap(path, np.uint8, "r")
        n = int(data[:8].view(np.uint64)[0])
        self.keys = data[8 : 8 + 8 * n].view(np.uint64)
        self.ends = data[8 + 8 * n : 8 + 16 * n].view(np.uint64)
        self.blocked = data[8 + 16 * n : 8 + 17 * n]
        self.text = data[8 + 17 * n :]

    @staticmethod
    def write(rules: list[Rule], path: str) -> None:
        named = sorted(((xxhash.xxh64_intdigest(r.name), r.name.encode(), r.verdict) for r in rules))
        with open(path, "wb") as f:
            f.write(np.array([len(named)], np.uint64).tobytes())
            f.write(np.array([k for k, *_ in named], np.uint64).tobytes())
            f.write(np.cumsum([len(s) for _, s, _ in named], dtype=np.uint64).tobytes())
            f.write(bytes(v == "block" for *_, v in named))
            f.write(b"".join(s for _, s, _ in named))

    def find(self, probes: list[bytes]) -> np.ndarray:
        """The number of the rule with exactly this string for each probe, -1 without one."""
        out = np.full(len(probes), -1, np.int64)
        digests = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, digests)
        near = np.flatnonzero(at < len(self.keys))
        for i in near[self.keys[at[near]] == digests[near]]:
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:  # equal digests of different strings stand together
                start = int(self.ends[k - 1]) if k else 0
                if self.text[start : int(self.ends[k])].tobytes() == probes[i]:
                    out[i] = k
                    break
                k += 1
        return out


def _probes(host: str, path: str, lengths: Iterable[int]) -> Iterator[str]:
    """Every rule name that could fit, each once, longest host first."""
    cuts = [path[:n] for n in lengths if n <= len(path)]
    while host:
        for cut in cuts:
            yield host + cut
        host = host.partition(".")[2]


def _send(spark, rules: list[Rule]) -> str:
    """Hand the file to Spark, which copies it to every executor, late ones included; its name there."""
    name = f"digests-{uuid.uuid4().hex}.bin"
    folder = os.path.join(SparkFiles.getRootDirectory(), "digests")  # the session's own, removed with it
    os.makedirs(folder, exist_ok=True)
    DigestArray.write(rules, os.path.join(folder, name))
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def filter_urls(pages: DataFrame, rules: list[Rule], *, url: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced).

    A rule fits its host and all subdomains if the URL's path starts with the rule's; the longest name wins, and of
    rules of one name ``block``. Without a rule the verdict is ``allow``. Null URLs and those without ``://`` have an
    empty host and path, fit no rule and are allowed.
    """
    spark = pages.sparkSession
    small_batches(spark)
    distinct: dict[tuple[str, str], Rule] = {}
    for r in sorted(rules, key=lambda r: r.verdict):
        distinct[r.host, r.path] = r
    lengths = sorted({len(p) for _, p in distinct})
    total = sum(17 + len(r.name.encode()) for r in distinct.values())
    files = max(1, -(-total // max_bytes))
    names = [
        _send(spark, [r for r in distinct.values() if xxhash.xxh64_intdigest(r.name) % files == k]) for k in range(files)
    ]

    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        probes, owner, host_length = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for probe in _probes(host, path, lengths):
                probes.append(probe)
                owner.append(i)
        best: dict[int, tuple[int, str, str]] = {}
        encoded = [p.encode() for p in probes]
        for name in names:
            array = DigestArray(SparkFiles.get(name))
            found = array.find(encoded)
            for j in np.flatnonzero(found >= 0):
                own = (len(probes[j]), probes[j], "block" if array.blocked[found[j]] else "allow")
                best[owner[j]] = max(best.get(owner[j], own), own)
        hits = [best.get(i) for i in range(len(hosts))]
        return pd.DataFrame({"rule": [h and h[1] for h in hits], "verdict": [h[2] if h else DEFAULT for h in hits]})

    judged = F.pandas_udf(judge, "rule string, verdict string")
    host, path = host_and_path(F.col(url))
    out = unclashed(pages, {"host", "path", "rule", "verdict"}).withColumns({"host": host, "path": path})
    out = out.withColumn("judged", judged("host", "path"))
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c != "judged"], "judged.rule", "judged.verdict")
