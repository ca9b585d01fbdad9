"""Spelling variants of words: one-edit pairs by merging errata tries, and the forms and roots that they give.

1. Words are counted over all texts, with partial sums on the map side.
2. Two words are near if one inserted, deleted or replaced character makes one the other. If the longer one has m
   characters and h = m // 2, near words share either the first h characters or the last m - h. So each word goes, for
   itself as the longer and as the shorter one, to the group of its first half and to that of its last half, where only
   the other half is left to compare. A group of more than MOST words is halved again in the same way; when one character
   is left to compare, a group holds an alphabet at most. No group is capped, and none is compared pair by pair.
3. Within a group the halves left make a trie. A heavy path goes on to the child with most words; the other children,
   the light ones, are merged into an errata trie, as if their first character was replaced, and walked against the
   heavy child; with that character skipped they are walked against the node itself, and against the heavy child's
   child, whose first character is the one skipped. Terminals that coincide are one-edit pairs. A word is in at
   most log2(words) light subtrees, so that is the number of times it is walked or copied.
4. The form of a word is its most frequent near word, if it is frequent enough; roots follow forms by pointer doubling.

Defined cases: a null text has no words; a null id counts as an empty one; ties go to the word first in code-point
order; a word without a form is its own root; an empty table gives an empty result; rows that repeat count each; other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspan.llm.common import sized, work_table

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Words of a group that is walked at once; larger ones are halved again.
MOST = 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, damage: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run of letters: word, A-Z lower-cased. damage: where it divides h, the crc32 of "<id>:<run>", the run
    loses its code point h % length, which plants known errors."""
    low = F.translate(F.col("run"), _UPPER, _LOWER)
    found = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run")).select("id", low.alias("word"))
    if damage is None:
        return found.select("word")
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("word")))
    place = (F.col("h") % F.length("word")).cast("int")
    less = F.concat(F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.length("word")))
    return found.select("word", h.alias("h")).select(F.when(F.col("h") % damage == 0, less).otherwise(F.col("word")).alias("word"))


def counted(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words that are long and frequent enough."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class _Node:
    """A node of a trie: its children by character, the words under it, and those that end here."""

    __slots__ = ("children", "ends", "size")

    def __init__(self) -> None:
        self.children: dict[str, _Node] = {}
        self.ends: list[int] = []
        self.size = 0


def _trie(rests: list[str]) -> _Node:
    top = _Node()
    for i, rest in enumerate(rests):
        at = top
        at.size += 1
        for c in rest:
            at = at.children.setdefault(c, _Node())
            at.size += 1
        at.ends.append(i)
    return top


def _coinciding(a: _Node, b: _Node) -> Iterator[tuple[int, int]]:
    """The pairs of words that end at the same place under a and under b."""
    wait = [(a, b)]
    while wait:
        x, y = wait.pop()
        for i in x.ends:
            for j in y.ends:
                yield i, j
        small, large = (x.children, y.children) if len(x.children) <= len(y.children) else (y.children, x.children)
        wait += [(x.children[c], y.children[c]) for c in small if c in large]


def _merge(into: _Node, light: _Node) -> None:
    """Copies a light subtree into an errata trie."""
    wait = [(into, light)]
    while wait:
        x, y = wait.pop()
        x.ends += y.ends
        for c, child in y.children.items():
            wait.append((x.children.setdefault(c, _Node()), child))


def one_edit(rests: list[str]) -> set[tuple[int, int]]:
    """The pairs i < j of distinct strings that one inserted, deleted or replaced character makes equal."""
    found: set[tuple[int, int]] = set()
    wait = [_trie(rests)]
    while wait:
        node = wait.pop()
        if node.size < 2:
            continue
        wait += node.children.values()
        if not node.children:
            continue
        key = max(node.children, key=lambda c: node.children[c].size)
        heavy, light = node.children[key], [(c, x) for c, x in node.children.items() if c != key]
        errata, pairs = _Node(), []
        pairs += [(i, j) for i in node.ends for j in heavy.ends]  # the heavy character skipped, at the end of a word
        for c, x in light:
            pairs += _coinciding(x, node)  # its character skipped
            if c in heavy.children:
                pairs += _coinciding(x, heavy.children[c])  # the heavy character skipped
            pairs += _coinciding(x, errata)  # replaced: light by light
            _merge(errata, x)
        pairs += _coinciding(errata, heavy)  # replaced: light by heavy
        found.update((min(p), max(p)) for p in pairs)
    return found


def _paired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs a, an, b, bn from rows (key, rest, word, n), sorted by key."""
    at, rests, words = None, [], []

    def solved() -> list[tuple]:
        return [(*words[i], *words[j]) for i, j in one_edit(rests)]

    def out(pairs: list[tuple]) -> pa.RecordBatch:
        a, an, b, bn = zip(*pairs, strict=True) if pairs else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(an, pa.int64()), pa.array(b, pa.string()), pa.array(bn, pa.int64())], names=["a", "an", "b", "bn"])

    for batch in batches:
        pairs = []
        for key, rest, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != at:
                if len(rests) > 1:
                    pairs += solved()
                at, rests, words = key, [], []
            rests.append(rest)
            words.append((word, n))
        if pairs:
            yield out(pairs)
    if len(rests) > 1:
        yield out(solved())


def _halved(rows: DataFrame) -> DataFrame:
    """rows (key, rest, long, word, n), where the longer words of a group have `long` characters left: each goes to the group of
    the first half of what is left and to that of its last half."""
    half = F.floor(F.col("long") / 2).cast("int")
    tail, size = F.col("long") - half, F.length("rest")

    def group(kind: str, shared: Column, rest: Column, long: Column) -> Column:
        return F.struct(F.concat("key", F.lit(kind), shared).alias("key"), rest.alias("rest"), long.alias("long"))

    first = group("<", F.substring("rest", F.lit(1), half), F.substring("rest", half + 1, size), tail)
    last = group(">", F.substring("rest", size - tail + 1, tail), F.substring("rest", F.lit(1), size - tail), half)
    return rows.select(F.explode(F.array(first, last)).alias("g"), "word", "n").select("g.key", "g.rest", "g.long", "word", "n")


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """words: a work table of word (of two characters at least), n. Each near pair once: a < b, an, bn."""
    length = F.length("word")
    both = words.select(F.explode(F.array(length, length + 1)).alias("long"), "word", "n").select(F.col("long").cast("string").alias("key"), F.col("word").alias("rest"), "long", "word", "n")
    at, ready = work_table(_halved(both), "halves"), []
    while True:
        hot = at.groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("key")
        hot = work_table(hot, "hot")
        if hot.isEmpty():
            ready.append(at)
            break
        ready.append(at.join(sized(hot), "key", "left_anti").unionByName(at.join(sized(hot), "key", "left_semi").where("long < 2")))
        at = work_table(_halved(at.join(sized(hot), "key", "left_semi").where("long > 1")), "halves")
    rows = ready[0]
    for more in ready[1:]:
        rows = rows.unionByName(more)
    dealt = rows.select("key", "rest", "word", "n").repartition("key").sortWithinPartitions("key")
    pairs = dealt.mapInArrow(_paired, "a string, an long, b string, bn long")
    swap = F.col("a") > F.col("b")
    ordered = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("an", "bn"), ("b", "a"), ("bn", "an"))]
    return pairs.select(*ordered).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """forms: word, form (not null), without a circle. word, root: the last form that is reached; pointers double each round."""
    at = work_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(sized(ahead), "root", "left_semi").isEmpty():
            return at
        at = work_table(at.join(sized(ahead), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def grouped(words: DataFrame, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """words: word, n, distinct. One row per word: word, form, root, n, n_near, form_n."""
    words = work_table(words, "words")
    pairs = work_table(near_pairs(words, most), "pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("m")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("an").alias("m")))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("near").alias("near"))).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    found = work_table(found, "forms")
    return found.join(roots(found.where("form IS NOT NULL")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group(docs: DataFrame, damage: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per frequent word of docs: word, form, root, n, n_near, form_n."""
    return grouped(counted(runs(docs, damage, id_col, text_col)))
