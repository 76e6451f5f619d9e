"""Near-duplicates by MinHash bands, odd sketches and exact confirmation.

A document is the set of its distinct word shingles (64-bit hashes). Equal sets are one node from the start, so groups of copies cost
one node. Each node has ``BANDS`` x ``ROWS`` MinHash samples for its bands. Its odd sketch folds the samples of a one-permutation MinHash (the
least hash in each of ``BINS`` bins) into a bitmap of ``BITS`` parities: the population count of the XOR of two sketches tells how many samples
differ, most precisely for high similarities.

Candidates are nodes that share a band. First every node is paired with the most central node (the one with most bucket mates) of each of its
buckets, the sketch picks the most similar of these, and that pair is confirmed on the full sets; the links give components. Then only pairs of
one bucket in different components are left to decide: members outside the bucket's largest component against the other members, each pair in the
first band it shares. Those with a sketch ``SIGMAS`` standard deviations worse than what a pair at the threshold has are set aside, the rest
confirmed on full sets. So a large group of near copies costs a few pairs per member, and still every candidate link between components is looked at.

A pair at the threshold shares no band with probability (1 - 0.8^5)^36 = 6e-7, and is set aside by its sketch with about 3e-7. Two
different sets or shingles get one 64-bit hash with a probability of 5e-20 a pair.

Words are lower-cased (A-Z) and cut at ASCII white space; with fewer words than a shingle has, the whole sequence is the one shingle. Null and
wordless texts have an empty set and are linked with nothing. Rows with equal id and text are the same document. Null ids are never the
smallest of a component that has other ids. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from latewatch.llm.common import groups, small, text_batches, written
from latewatch.llm.components import components

BANDS, ROWS = 36, 5
BINS, BITS = 8192, 2048
PERCENT = 80
SIGMAS = 5.0
WORDS = BITS // 64
SKETCH = [f"s{k}" for k in range(WORDS)]

_U = np.uint64
_rng = np.random.default_rng(20_240_229)
_A = _rng.integers(0, 2**63, BANDS * ROWS, dtype=_U) * _U(2) + _U(1)
_B = _rng.integers(0, 2**63, BANDS * ROWS, dtype=_U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    cut = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    code = {w: xxhash.xxh64_intdigest(w) for w in {w for ws in cut for w in ws}}
    out = []
    for words in cut:
        h = np.fromiter(map(code.__getitem__, words), _U, len(words))
        n = len(h) - size + 1
        if not len(h):
            out.append(h)
            continue
        if n < 1:
            acc = np.array([len(h)], _U)
            for x in h:
                acc = _mix(acc ^ x)
        else:
            acc = h[:n]
            for k in range(1, size):
                acc = _mix(acc) ^ h[k : k + n]
            acc = _mix(acc)
        out.append(np.unique(acc))
    return out


def samples(s: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set."""
    out = np.full(len(_A), np.iinfo(_U).max, _U)
    for k in range(0, len(s), 512):
        np.minimum(out, (s[k : k + 512, None] * _A + _B).min(axis=0), out=out)
    return out


def sketch(s: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of one-permutation samples of a sorted set, and their odd sketch: one parity bit per hash value of the samples."""
    bins = s >> _U(64 - BINS.bit_length() + 1)
    least = s[np.flatnonzero(np.diff(bins, prepend=_U(BINS)))]
    bit = (_mix(least ^ _U(0x9E3779B97F4A7C15)) >> _U(64 - BITS.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(bit, minlength=BITS) & 1).astype(np.uint8)
    return len(least), np.packbits(odd).view(np.int64)


def signatures(df: DataFrame, size: int, text: str = "text") -> DataFrame:
    """``df`` with ``sig``: n (size of the set), node (hash of the set), held (samples in the sketch), s0.. (sketch), bands (bucket numbers)."""
    band = np.arange(1, BANDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)

    @F.pandas_udf(f"n long, node long, held long, {', '.join(f'{s} long' for s in SKETCH)}, bands array<long>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            rows = []
            for group in groups(texts.tolist()):
                for s in shingle_sets(group, size):
                    if not len(s):
                        rows.append((0, 0, 0, *[0] * WORDS, []))
                        continue
                    m = samples(s)
                    acc = band.copy()
                    for k in range(ROWS):
                        acc = _mix(acc ^ m[k::ROWS])
                    held, bits = sketch(s)
                    rows.append((len(s), xxhash.xxh64_intdigest(s.tobytes()), held, *bits.tolist(), acc.view(np.int64)))
            out = pd.DataFrame(rows, columns=["n", "node", "held", *SKETCH, "bands"])
            out["node"] = out["node"].astype("uint64").to_numpy().view("int64")
            yield out

    text_batches(df.sparkSession)
    return df.withColumn("sig", run(F.col(text)))


def _sets(df: DataFrame, size: int, text: str) -> DataFrame:
    """(node, items) of each row. A map and not a column: filters on its result must not make Spark compute it again."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for group in groups(part[text].tolist()):
                items = [s.tobytes() for s in shingle_sets(group, size)]
                node = np.array([xxhash.xxh64_intdigest(b) for b in items], np.uint64).view(np.int64)
                yield pd.DataFrame({"node": node, "items": items})

    text_batches(df.sparkSession)
    return df.select(text).mapInPandas(run, "node long, items binary")


@F.pandas_udf(BooleanType())
def _linked(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x: bytes, y: bytes) -> bool:
        u, v = np.frombuffer(x, _U), np.frombuffer(y, _U)
        both = len(np.intersect1d(u, v, assume_unique=True))
        return 100 * both >= PERCENT * (len(u) + len(v) - both)

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are linked by their full sets."""
    left, right = (sets.select(F.col("node").alias(c), F.col("items").alias(f"{c}_items")) for c in "ab")
    return written(pairs.join(left, "a").join(right, "b").where(_linked("a_items", "b_items")).select("a", "b"), "links")


def _bits(left: str, right: str) -> Column:
    """Parities in which two sketches differ."""
    total = F.lit(0)
    for s in SKETCH:
        total = total + F.bit_count(F.col(f"{left}{s}").bitwiseXOR(F.col(f"{right}{s}")))
    return total


def most_bits(n: Column, held: Column) -> Column:
    """Parities in which a pair at the threshold differs, ``SIGMAS`` standard deviations above the mean. ``n``, ``held``: sums of both sizes
    and of both numbers of samples.

    At the threshold the union has n / (1 + 0.8) elements, of which u are the least of their bin (expected in the same proportion to the samples of
    both as in the mean), and 0.8 u of those are common. Taking u of the union without replacement, filling the bins, and throwing the
    differing samples into the bitmap, each have a variance.
    """
    share = PERCENT / 100
    union = n / (1 + share)
    empty = F.exp(-union / BINS)
    u = held * (1 - empty) / (2 * (1 - F.exp(-n / (2 * BINS))))
    differing = F.greatest(held - 2 * share * u, F.lit(0.0))
    left = F.exp(-2 * differing / BITS)
    drawn = 4 * share * (1 - share) * u * F.greatest(union - u, F.lit(0.0)) / union
    filled = share * share * BINS * (empty - (1 + union / BINS) * empty * empty)
    thrown = F.greatest(BITS / 4 * (1 - left * left) - left * left * differing, F.lit(0.0))
    return BITS / 2 * (1 - left) + SIGMAS * F.sqrt(left * left * (drawn + filled) + thrown + 0.5)


def may_link(left: str, right: str) -> Column:
    """What sizes and sketches say: False only for pairs below the threshold."""
    sizes = [F.col(f"{left}n"), F.col(f"{right}n")]
    likely = _bits(left, right) <= most_bits(sizes[0] + sizes[1], F.col(f"{left}held") + F.col(f"{right}held"))
    return (100 * F.least(*sizes) >= PERCENT * F.greatest(*sizes)) & likely


def find(docs: DataFrame, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``text_key`` (hash of the text), ``n_shingles``, ``component_id``, ``kept``."""
    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t"))
    sigs = signatures(rows, size, "t").select("d", F.xxhash64(F.coalesce("t", F.lit(""))).alias("k"), "sig.*")
    sigs = written(sigs, "signatures")
    full = sigs.where("n > 0")
    nodes = full.groupBy("node").agg(F.min("d").alias("rep"))
    bands = full.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = bands.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("bucket")
    members = written(bands.join(shared, "bucket").distinct(), "members")
    mates = members.join(members.groupBy("bucket").agg(F.count("*").alias("m")), "bucket").groupBy("node").agg(F.sum("m").alias("mates"))
    leaders = members.join(mates, "node").groupBy("bucket").agg(F.max_by("node", "mates").alias("leader"))
    near = full.join(mates.select("node"), "node", "left_semi").groupBy("node").agg(
        F.min("d").alias("rep"), *[F.first(c).alias(c) for c in ("n", "held", *SKETCH, "bands")],
    )
    near = written(near, "near-nodes")

    ids = small(written(near.select(F.col("rep").alias("r")).distinct(), "near-ids"))
    needed = rows.join(ids, F.col("d").eqNullSafe(F.col("r")), "left_semi")
    needed = _sets(needed, size, "t")
    sets = written(needed.join(near.select("node"), "node", "left_semi").groupBy("node").agg(F.first("items").alias("items")), "sets")

    def described(df: DataFrame, column: str, prefix: str, *more: str) -> DataFrame:
        """``df`` with what is known of the node in ``column``."""
        return df.join(near.select(F.col("node").alias(column), *[F.col(c).alias(f"{prefix}{c}") for c in ("n", "held", *SKETCH, *more)]), column)

    stars = members.join(leaders, "bucket").where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    stars = described(described(stars, "a", "x"), "b", "y").where(may_link("x", "y"))
    best = stars.groupBy("a").agg(F.min_by("b", _bits("x", "y") / (F.col("xn") + F.col("yn"))).alias("b"))
    links = confirmed(best, sets)
    root = written(components(links), "components")

    labelled = members.join(root, "node", "left").select("bucket", "band", "node", F.coalesce("root", "node").alias("c"))
    sizes = labelled.groupBy("bucket", "c").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("bucket").agg(F.max_by("c", F.struct("size", "c")).alias("main"), F.count("*").alias("all")).where("all > 1").drop("all")
    mixed = written(described(labelled.join(mixed, "bucket"), "node", "x", "bands"), "mixed-buckets")
    other = mixed.where("c <> main").select(
        "bucket", F.col("node").alias("o"), F.col("c").alias("oc"), *[F.col(f"x{c}").alias(f"y{c}") for c in ("n", "held", *SKETCH, "bands")],
    )
    earlier = F.arrays_zip(F.slice("xbands", 1, F.col("band")).alias("x"), F.slice("ybands", 1, F.col("band")).alias("y"))
    once = ((F.col("c") == F.col("main")) | (F.col("node") < F.col("o"))) & ~F.exists(earlier, lambda e: e["x"] == e["y"])
    open_pairs = mixed.join(other, (mixed["bucket"] == other["bucket"]) & (F.col("c") != F.col("oc")) & may_link("x", "y") & once)
    open_pairs = written(open_pairs.select(F.least("node", "o").alias("a"), F.greatest("node", "o").alias("b")).distinct(), "open-pairs")
    more = confirmed(open_pairs, sets)

    up = more.join(root.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(
        root.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left",
    ).select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    top = components(up).select(F.col("node").alias("c"), F.col("root").alias("top"))
    final = near.select("node", "rep").join(root, "node", "left").withColumn("c", F.coalesce("root", "node")).join(top, "c", "left")
    final = written(final.select("node", "rep", F.coalesce("top", "c").alias("c")), "final-components")

    # a node outside of all shared buckets is its own component: the rows of one set
    by_component = final.groupBy("c").agg(F.min("rep").alias("component"))
    of_near = final.join(by_component, "c").select("node", "component")
    label_of = nodes.select("node", "rep").join(of_near, "node", "left").select("node", F.coalesce("component", "rep").alias("component"))
    out = sigs.select("d", "k", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(label_of, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("d"))
    return out.select(
        F.col("d").alias(doc_id), F.col("k").alias("text_key"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("d").eqNullSafe(component).alias("kept"),
    )


def keep_one(docs: DataFrame, size: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id, once. Columns are kept."""
    found = written(find(docs, size).select("doc_id", "text_key", "kept"), "near-duplicates")
    gone = small(written(found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct(), "gone"))
    same = docs["doc_id"].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_gone_key"])
    kept = docs.join(gone, same, "left_anti")
    repeated = found.where("kept").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Two-word shingles, all pairs that share one, and the closure of the links: for small tables only.
SQL = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
