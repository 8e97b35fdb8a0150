"""URL filters over a sorted digest array.

The entries of a filter are kept in one file: their 64-bit xxhash keys in ascending order, an action for
each, and the full strings. Workers memory-map the file, look for all keys of a batch of URLs by one
vectorised binary search, and compare the stored string with the probed one, so that two strings of one
digest are told apart. The file is written to the shared folder and handed out by SparkContext.addFile;
a new executor fetches it again.
"""

from __future__ import annotations

import functools
import hashlib
import mmap
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.batches import slices, widened
from lectern.llm.shared import shared_dir, write_bytes

_HEAD = struct.Struct("<8sQQQ")
_MAGIC = b"urlarr02"
_ACTIONS = ("allow", "block")
#: The array is built on the driver; a longer list is refused, not cut.
MAX_ENTRIES = 20_000_000

#: The rules of the registered query.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def digest_array(rules: Iterable[tuple[str, str]]) -> bytes:
    """The file's bytes: head, keys, offsets of the strings, actions, path lengths and numbers of dots in hosts that occur, strings."""
    held: dict[str, str] = {}
    for rule, action in rules:
        if action not in _ACTIONS:
            raise ValueError(f"neither allow nor block: {action}")
        held[rule] = max(held.get(rule, ""), action)  # a rule given both ways blocks
        if len(held) > MAX_ENTRIES:
            raise ValueError(f"over {MAX_ENTRIES} entries")
    order = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), _ACTIONS.index(a)) for r, a in held.items())
    keys = np.array([k for k, _, _ in order], "<u8")
    ends = np.cumsum([0] + [len(r) for _, r, _ in order]).astype("<u8")
    lengths = np.array(sorted({len(r.decode()) - len(r.decode().split("/", 1)[0]) for _, r, _ in order}), "<u8")
    dots = np.array(sorted({r.split(b"/", 1)[0].count(b".") for _, r, _ in order}), "<u8")
    actions = np.array([a for _, _, a in order], "<u8")
    return _HEAD.pack(_MAGIC, len(keys), len(lengths), len(dots)) + b"".join(x.tobytes() for x in (keys, ends, actions, lengths, dots)) + b"".join(r for _, r, _ in order)


class DigestArray:
    """A memory-mapped digest array."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        magic, n, m, d = _HEAD.unpack_from(self._map)
        if magic != _MAGIC:
            raise ValueError(f"not a digest array: {path}")
        whole = np.frombuffer(self._map, "<u8", 3 * n + 1 + m + d, _HEAD.size)
        self.keys, self.ends, self.actions, self.path_lengths, self.dots = np.split(whole, [n, 2 * n + 1, 3 * n + 1, 3 * n + 1 + m])
        self.longest = int(np.diff(self.ends).max()) if n else 0
        self._strings = _HEAD.size + whole.nbytes

    def find(self, probes: list[bytes]) -> np.ndarray:
        """For each probe its entry, or -1."""
        want = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        low, high = np.searchsorted(self.keys, want, "left"), np.searchsorted(self.keys, want, "right")
        out = np.full(len(probes), -1, np.int64)
        for k in np.flatnonzero(high > low):
            for e in range(low[k], high[k]):  # over one only if digests collide
                a, b = self._strings + int(self.ends[e]), self._strings + int(self.ends[e + 1])
                if self._map[a:b] == probes[k]:
                    out[k] = e
        return out


@functools.lru_cache(maxsize=4)
def _opened(path: str) -> DigestArray:
    return DigestArray(path)


def publish(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> str:
    """Writes the array to the shared folder, hands it to all executors, and gives its name among SparkFiles."""
    data = digest_array(rules)
    name = f"url-digests-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    if not any(f.endswith("/" + name) for f in spark.sparkContext.listFiles):
        path = f"{shared_dir(spark)}/{name}"
        write_bytes(spark, path, data)
        spark.sparkContext.addFile(path)
    return name


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a URL; both empty if it is null or has no '://'."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _suffixes(host: str, dots: list[int], longest: int) -> Iterator[str]:
    """The ends of a host, from its labels on, that hold so many dots as some entry's host, and no more characters than any."""
    at, wanted = len(host), iter(dots)
    want = next(wanted, -1)
    for k in range(dots[-1] + 1 if dots else 0):
        at = host.rfind(".", max(0, len(host) - longest - 1), at)
        if at < 0 and len(host) > longest:
            return
        if k == want:
            if len(host) > at + 1:
                yield host[at + 1 :]
            want = next(wanted, -1)
        if at < 0:
            return


def url_filter(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict added; columns of those names are replaced.

    A rule is a host and a path, like 'example.com/en/'. It fits its host and every subdomain of it where
    the URL's path starts with the rule's. The longest fitting rule gives the verdict; of equally long
    ones a blocking rule, then the smaller string. A URL that no entry fits (also a null one, or one
    without '://') has a null rule and the verdict default.
    """
    spark = pages.sparkSession
    name = publish(spark, rules)
    new = ["host", "path", "rule", "verdict"]
    pages = pages.drop(*new)
    host, path = host_and_path(F.col("url"))
    parsed = pages.withColumn("host", host).withColumn("path", path)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = _opened(SparkFiles.get(name))
        lengths, dots, longest = array.path_lengths.tolist(), array.dots.tolist(), array.longest
        for batch in slices(batches):
            probes, owner = [], []
            for k, (h, p) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)):
                ends = [p[:n] for n in lengths if n <= len(p)]
                for s in _suffixes(h, dots, longest):
                    for e in ends:
                        if len(s) + len(e) <= longest:
                            probes.append((s + e).encode("utf-8", "surrogatepass"))
                            owner.append(k)
            best: list[tuple | None] = [None] * batch.num_rows
            for q in np.flatnonzero((found := array.find(probes)) >= 0):
                rule, action = probes[q].decode(), int(array.actions[found[q]])
                rank = (-len(rule), -action, rule, action)
                if best[owner[q]] is None or rank < best[owner[q]]:
                    best[owner[q]] = rank
            rule = pa.array([b and b[2] for b in best], pa.string())
            verdict = pa.array([_ACTIONS[b[3]] if b else default for b in best], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], [*batch.schema.names, "rule", "verdict"])

    return parsed.mapInArrow(judge, widened(parsed.schema, rule="string", verdict="string"))


#: The registered query in SQL.
SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule_host, rule_path, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON s.page_id = f.page_id AND f.place = 1
"""
