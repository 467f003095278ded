"""Allow and block rules for URLs, looked up in a sorted digest array.

A rule is a host and a path; it fits its host and all subdomains when the URL's path starts with the rule's path. The
index file holds the rules' 64-bit xxhash keys in ascending order and the rules' strings; it is written to the shared
folder, added to the job's files and memory-mapped by each worker. A URL is probed with the digests of all pairs of a
host suffix and a path prefix of a length that some rule has, by one vectorised binary search per block of URLs; where
a digest is found, the stored string is compared, so a collision cannot decide. The longest rule that fits wins, of
rules of one length that with the longer host. Only suffixes of as many labels as some rule's host has are probed.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.session import scratch_path

MAX_INDEX_BYTES = 1 << 30  # every worker's machine holds a copy of the file

_HEAD = struct.Struct("<QQ")


class Rule(NamedTuple):
    host: str
    path: str
    allow: bool


def build_index(rules: Sequence[Rule]) -> bytes:
    """The index file: counts, sorted digests, end offsets, verdicts, strings, and the rules' path lengths and label counts.

    A rule given twice must say the same both times. Rules without a host are refused.
    """
    verdicts: dict[str, tuple[bool, int]] = {}
    for host, path, allow in rules:
        text = host.lower() + path
        if not host or "/" in host:
            raise ValueError(f"a rule needs a plain host: {host!r}")
        if verdicts.setdefault(text, (allow, len(path)))[0] != allow:
            raise ValueError(f"both allowed and blocked: {text}")
    ordered = sorted((xxhash.xxh64_intdigest(t.encode()), t.encode(), a, n) for t, (a, n) in verdicts.items())
    digests = np.array([x[0] for x in ordered], "<u8")
    ends = np.cumsum([len(x[1]) for x in ordered], dtype="<u8")
    allow = np.array([x[2] for x in ordered], np.uint8)
    labels = sorted({len(host.split(".")) for host, _, _ in rules}, reverse=True)
    lengths = json.dumps([sorted({x[3] for x in ordered}), labels]).encode()
    packed = b"".join([_HEAD.pack(len(ordered), len(lengths)), digests.tobytes(), ends.tobytes(), allow.tobytes(),
                       lengths, *[x[1] for x in ordered]])
    if len(packed) > MAX_INDEX_BYTES:
        raise ValueError(f"the index would take {len(packed)} bytes; split the rules by host")
    return packed


class DigestArray:
    """A memory-mapped index file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, extra = _HEAD.unpack(raw[:_HEAD.size].tobytes())
        at = _HEAD.size
        self.digests, at = raw[at:at + 8 * n].view("<u8"), at + 8 * n
        self.ends, at = raw[at:at + 8 * n].view("<u8"), at + 8 * n
        self.allow, at = raw[at:at + n], at + n
        self.path_lengths, self.labels = json.loads(raw[at:at + extra].tobytes())
        at += extra
        self.strings = raw[at:]

    def string(self, i: int) -> str:
        return self.strings[int(self.ends[i - 1]) if i else 0:int(self.ends[i])].tobytes().decode()

    def find(self, keys: list[str]) -> np.ndarray:
        """The entry of every key, -1 where it is not stored."""
        found = np.full(len(keys), -1)
        if not len(keys) or not len(self.digests):
            return found
        wanted = np.array([xxhash.xxh64_intdigest(k.encode()) for k in keys], "<u8")
        at = np.searchsorted(self.digests, wanted)
        hit = np.flatnonzero((at < len(self.digests)) & (self.digests[np.minimum(at, len(self.digests) - 1)] == wanted))
        for k in hit.tolist():
            i = int(at[k])
            while i < len(self.digests) and self.digests[i] == wanted[k]:  # equal digests lie side by side
                if self.string(i) == keys[k]:
                    found[k] = i
                    break
                i += 1
        return found


def longest_fits(array: DigestArray, hosts: list[str], paths: list[str]) -> list[int]:
    """The longest fitting rule's entry for every URL, -1 for none."""
    keys: dict[str, int] = {}
    tried: list[list[int]] = []
    for host, path in zip(hosts, paths):
        own = []
        labels = host.split(".")
        for count in array.labels:  # the longest host first, which wins among rules of one length
            if count <= len(labels):
                suffix = ".".join(labels[len(labels) - count:])
                own += [keys.setdefault(suffix + path[:n], len(keys)) for n in array.path_lengths if n <= len(path)]
        tried.append(own)
    found = array.find(list(keys)).tolist()
    best = []
    for own in tried:
        fits = [found[k] for k in own if found[k] >= 0]
        best.append(max(fits, key=lambda i: len(array.string(i)), default=-1))
    return best


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """Behind the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _publish(spark: SparkSession, packed: bytes) -> str:
    folder = scratch_path(spark, "urls")
    store, place = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    name = f"rules-{uuid.uuid4().hex}.idx"
    store.create_dir(place, recursive=True)
    with store.open_output_stream(f"{place}/{name}") as out:
        out.write(packed)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, the rule that decided (host and path in one string, or null), and the verdict.

    A URL that no rule fits, also one that is null, empty or without `://`, gets `default`. Repeated rows and null ids
    are judged row by row. Of rules of one length that fit, that with the longer host decides. Columns other than id and URL
    are dropped; an empty table has no rows.
    """
    name = _publish(pages.sparkSession, build_index(rules))
    split = pages.select(F.col(id_col).cast("long").alias("page_id"), url_host(F.col(url_col)).alias("host"),
                         url_path(F.col(url_col)).alias("path"))

    def look_up(batches):
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            best = longest_fits(array, batch.column("host").to_pylist(), batch.column("path").to_pylist())
            rule = [array.string(i) if i >= 0 else None for i in best]
            verdict = [default if i < 0 else "allow" if array.allow[i] else "block" for i in best]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return split.mapInArrow(look_up, "page_id long, host string, path string, rule string, verdict string")
