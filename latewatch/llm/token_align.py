"""Alignment of two tokenizations of the same bytes: groups of tokens between shared ends, and links between tokens that end together.

Each text is tokenised as a whole by both tokenizers: a space and the text byte-level (A), the text alone by pieces with byte fallback, which put that
space in front themselves (B). Only where the joined bytes of both equal the space and the text is there anything to align; byte places
of a token are then running sums of token lengths. Places where both sides start a space-marked token, so that both ended one there, are anchors: they
cut a text into windows of a few tokens, mostly one word. The groups of a window depend on its two tuples of ids only, so each worker keeps the alignment of
the windows it has met, by these tuples; all new windows of a batch of texts are aligned in one numpy step, and the results of the texts are put together from
the kept alignments.

A group is a run of A tokens and a run of B tokens between two shared ends with none in between. Its last two tokens are the one pair of it that
ends together, hence a link, and a text has as many links as groups. Distinct links of each text are written with their numbers; Spark adds them up over
all texts, finds the highest count of each B id, and joins both back. The table of counts is broadcast if it is measured to be small.

Where the file of A is a byte-level vocabulary whose merges stand in the order of their ids, cut by the usual pattern, a faster library merges by the ranks of
that same file; the ids are equal (tested). Other files are read by the library of their format.

Null and empty texts, and those whose bytes differ (control characters that a side drops, U+2581 itself), have no tokens, groups or links. Repeated
rows all count and each get a row; null and equal ids are allowed. Empty tables give empty results; other columns are kept by ``align``. The vocabulary files are
read on the driver and broadcast; their size is that of a vocabulary.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latewatch.llm.common import GROUP_CHARS, fits, groups, text_batches, written

STORE = 250_000  # windows that a worker keeps, and a multiple of it in tokens; it starts afresh when the store is full
STORE_TOKENS = 12
BLOCK = 100_000  # windows that are put together at a time
SPACE = "▁"
PAIR = 1 << 32
MARK = PAIR - 1  # no id
# Fixed value: the pattern that cuts a text before byte-level merging, as the format of A applies it.
CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Byte strings by number."""

    def __init__(self, words: list[bytes]):
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(words), np.uint8)
        self.spaced = np.array([w.startswith(b" ") for w in words], bool)
        self.words = words

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of consecutive runs: from each start as many as its size."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Alignments:
    """Kept windows: by their id tuples a number, and for each number the tokens of its groups in order and the links."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.items, self.links = np.empty(0, np.int64), np.empty(0, np.int64)
        self.item_starts = self.item_sizes = self.link_starts = self.link_sizes = np.empty(0, np.int64)

    def add(self, items, item_sizes, links, link_sizes) -> None:
        self.item_starts = np.concatenate([self.item_starts, len(self.items) + np.cumsum(item_sizes) - item_sizes])
        self.link_starts = np.concatenate([self.link_starts, len(self.links) + np.cumsum(link_sizes) - link_sizes])
        self.item_sizes, self.link_sizes = np.concatenate([self.item_sizes, item_sizes]), np.concatenate([self.link_sizes, link_sizes])
        self.items, self.links = np.concatenate([self.items, items]), np.concatenate([self.links, links])


class Aligner:
    def __init__(self, json_a: str, model_b: bytes):
        from sentencepiece import SentencePieceProcessor

        self.b = SentencePieceProcessor(model_proto=model_b)
        raw = json.loads(json_a)
        level, known = byte_level(), raw["model"]["vocab"]
        added = {t["id"]: t["content"].encode() for t in raw.get("added_tokens", [])}
        words = [b""] * (max([*known.values(), *added]) + 1)
        for w, i in known.items():
            words[i] = added[i] if i in added else bytes(level[c] for c in w)
        for i, w in added.items():
            words[i] = w
        self.bytes_a = Vocabulary(words)
        self.encode_a = _ranked(raw, words, added) or _listed(json_a)
        ids = range(self.b.get_piece_size())
        self.bytes_b = Vocabulary([
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(SPACE, " ").encode() for i in ids
        ])
        # every id as text, followed by each of the three signs that may come after it
        shown = Vocabulary([f"{i}{sign}".encode() for i in range(max(len(words), len(ids))) for sign in ",|;"])
        self.shown_starts, self.shown_sizes, self.shown = shown.starts, shown.lengths, shown.flat
        self.kept = Alignments()

    def align_new(self, a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> tuple[np.ndarray, ...]:
        """Alignments of windows of ``wa`` and ``wb`` tokens that follow one another in ``a`` and ``b``: items, items per window, links, links per window.

        An item is three times an id plus the place of the sign after it in ",|;".
        """
        end_a, end_b = np.cumsum(self.bytes_a.lengths[a]), np.cumsum(self.bytes_b.lengths[b])
        at = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[np.minimum(at, len(end_b) - 1)] == end_a)  # ends of windows are shared, so each group lies in one
        last_b = at[last_a]
        group_a, group_b = np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))
        before_b, through_a = np.concatenate([[0], last_b + 1]), last_a + 1
        items = np.empty(len(a) + len(b), np.int64)
        sign = np.zeros(len(a), np.int64)
        sign[last_a] = 1
        items[np.arange(len(a)) + before_b[group_a]] = 3 * a + sign
        sign = np.zeros(len(b), np.int64)
        sign[last_b] = 2
        items[np.arange(len(b)) + through_a[group_b]] = 3 * b + sign
        window = np.searchsorted(np.cumsum(wa), last_a, "right")
        return items, wa + wb, a[last_a] * PAIR + b[last_b], np.bincount(window, minlength=len(wa))

    def together(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> list[tuple]:
        """(n_a, n_b, n_groups, groups, pairs, times) of texts whose bytes agree, all at once."""
        ids_a, ids_b = (np.concatenate([np.array(x, np.int64) for x in side]) for side in (a, b))
        start_a, start_b = (np.cumsum(v.lengths[i]) - v.lengths[i] for v, i in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)))
        # space-marked tokens of both sides at one place: the tokens before them ended there, too; a text begins with such a pair
        cut_a, cut_b = np.flatnonzero(self.bytes_a.spaced[ids_a]), np.flatnonzero(self.bytes_b.spaced[ids_b])
        place = np.searchsorted(start_b[cut_b], start_a[cut_a])
        both = np.flatnonzero(np.append(start_b[cut_b], -1)[place] == start_a[cut_a])
        cut_a, cut_b = np.append(cut_a[both], len(ids_a)), np.append(cut_b[place[both]], len(ids_b))
        if len(self.kept.places) > STORE or len(self.kept.items) > STORE_TOKENS * STORE:
            self.kept = Alignments()
        # the two tuples of a window as one run of numbers: its A ids, a mark, its B ids
        wa, wb = np.diff(cut_a), np.diff(cut_b)
        number = np.arange(len(wa))
        tuples = np.full(len(ids_a) + len(ids_b) + len(wa), MARK, "<u4")
        tuples[np.arange(len(ids_a)) + np.repeat(cut_b[:-1] + number, wa)] = ids_a
        tuples[np.arange(len(ids_b)) + np.repeat(cut_a[1:] + number + 1, wb)] = ids_b
        packed, cuts = tuples.tobytes(), (4 * np.concatenate([[0], np.cumsum(wa + wb + 1)])).tolist()
        keys = [packed[i:j] for i, j in zip(cuts, cuts[1:])]
        places = self.kept.places
        n = len(places)
        first = []
        window = np.array([-1 if x is None else x for x in map(places.get, keys)], np.int64)
        for k in np.flatnonzero(window < 0).tolist():
            at = places.setdefault(keys[k], n)
            if at == n:
                first.append(k)
                n += 1
            window[k] = at
        first = np.array(first, np.int64)
        if len(first):
            wa, wb = wa[first], wb[first]
            self.kept.add(*self.align_new(ids_a[_spread(cut_a[first], wa)], ids_b[_spread(cut_b[first], wb)], wa, wb))
        ends = np.searchsorted(cut_a, np.cumsum([len(x) for x in a]))  # a text ends with a window
        out, start = [], 0
        for x, y, end in zip(a, b, ends.tolist(), strict=True):
            shown, pairs = [], []
            for k in range(start, end, BLOCK):
                some = window[k : min(end, k + BLOCK)]
                items = self.kept.items[_spread(self.kept.item_starts[some], self.kept.item_sizes[some])]
                shown.append(self.shown[_spread(self.shown_starts[items], self.shown_sizes[items])].tobytes())
                pairs.append(self.kept.links[_spread(self.kept.link_starts[some], self.kept.link_sizes[some])])
            every = np.concatenate(pairs)
            distinct, times = np.unique(every, return_counts=True)
            out.append((len(x), len(y), len(every), b"".join(shown)[:-1].decode(), distinct, times))
            start = end
        return out

    def agree(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether both sides hold the bytes of a space and the text."""
        if not text or not a or not b:
            return False
        whole = b" " + text.encode("utf-8", "surrogatepass")
        return self.bytes_a.joined(a) == whole and self.bytes_b.joined(b) == whole

    def many(self, texts: list[str]) -> list[tuple]:
        a, b = self.encode_a([" " + t for t in texts]), self.b.encode(texts, num_threads=1)
        good = [k for k in range(len(texts)) if self.agree(texts[k], a[k], b[k])]
        out = [(0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))] * len(texts)
        if good:
            for k, made in zip(good, self.together(*([x[k] for k in good] for x in (texts, a, b))), strict=True):
                out[k] = made
        return out


def _ranked(raw: dict, words: list[bytes], added: dict[int, bytes]):
    """An encoder by ranks if the file says no more than that: byte-level, the usual cut, each merge making the next id."""
    model, cut = raw["model"], raw.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not raw.get("normalizer")
    plain = plain and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model["vocab"]
    if not plain or any(vocab.get(x + y) != 256 + k for k, (x, y) in enumerate(pairs)) or len(vocab) != 256 + len(pairs) + len(added.keys() & set(vocab.values())):
        return None
    import tiktoken

    ranks = {w: i for i, w in enumerate(words) if i not in added}
    encode = tiktoken.Encoding("a", pat_str=CUT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda texts: [encode(t) for t in texts]


def _listed(json_a: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    library = Tokenizer.from_str(json_a)
    library.encode_special_tokens = True
    return lambda texts: [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]


_MADE: dict[tuple, Aligner] = {}


def _aligner(files: tuple[str, bytes]) -> Aligner:
    key = (hash(files[0]), hash(files[1]))
    if key not in _MADE:
        _MADE[key] = Aligner(*files)
    return _MADE[key]


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``df`` with ``alignment``: struct of ``n_a``, ``n_b``, ``n_groups`` (long), ``groups`` (text ``a1,a2|b1;a3|b2,b3``), and the distinct links as ``pairs``
    (A id times 2**32 plus B id) with their numbers ``times``."""
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        files = df.sparkSession.sparkContext.broadcast((f.read(), g.read()))

    @F.pandas_udf("n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<long>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        aligner = _aligner(files.value)
        for texts in parts:
            out = [x for group in groups(texts.tolist(), GROUP_CHARS // 2) for x in aligner.many(group)]
            yield pd.DataFrame(out, columns=["n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    text_batches(df.sparkSession)
    return df.withColumn("alignment", run(F.col(text)))


def link_counts(stored: DataFrame) -> DataFrame:
    """(pair, count, best): how many links hold an id pair, and whether no pair of its B id is held by more."""
    links = stored.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = links.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    by_b = Window.partitionBy(F.col("pair").bitwiseAND(PAIR - 1))
    return counts.withColumn("best", F.col("count") == F.max("count").over(by_b))


def compare(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("d"), F.col(text).alias("text"))
    digest = F.when(F.col("alignment.n_groups") > 0, F.sha2("alignment.groups", 256)).otherwise("")
    stored = written(
        align(rows, path_a, path_b).select("row", "d", *[f"alignment.{c}" for c in ("n_a", "n_b", "n_groups", "pairs", "times")], digest.alias("groups_sha256")),
        "alignments",
    )
    counts = written(link_counts(stored), "link-counts")
    links = stored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = links.join(fits(counts), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    return stored.join(sums, "row", "left").select(
        F.col("d").alias(doc_id), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )
