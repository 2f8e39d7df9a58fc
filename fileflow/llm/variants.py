"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Every word is arranged by its frequency vector, the numbers of its letters in
each of ``GROUPS`` letter groups.  Level d of the trie branches on the count of
group d; a leaf holds the words of one vector.  One inserted code point adds one to
one count, a deleted one takes one away, a replaced one does both or neither.  So a
depth-first search carries a budget of one surplus and one deficit: at each
level it goes to the child with the same count, one more or one less as the
budget allows, and the words of the leaves it reaches are verified letter by
letter.  Of two different vectors only the one that is less in their first
difference searches, and the find counts for both.

At scale the top of the trie is cut into shards: a node of more than
``shard_words`` words is heavy and its children go on, others are shards.  The
heavy nodes (at most words / shard_words a level) are counted by Spark and go
to the tasks; a word walks this top with the same budgets and is sent to the
shards it reaches.  A shard's task builds the rest of the trie over
its words as sorted arrays and searches it depth first, a block of search states
at a time, so memory is bounded by the shard and the block.  A leaf that is
heavy itself is dealt over numbered shards.  Tasks return one row a word: its
number of near words and the most frequent one.  Forms are then followed to
their roots by pointer doubling; a form is ``ratio`` times as frequent, so chains
have at most log_ratio(n) steps.

Defined results: a null text has no words, a null doc_id is written as nothing
in the hash of the query; rows that repeat count as often as they are there;
words of any length, also of one letter repeated, are compared whole; an empty
table gives an empty result.  Equal frequencies are settled by code points.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm.common import saved, table

#: Letter groups: the code point modulo this number.
GROUPS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Search states that a task expands at a time.
BLOCK = 1 << 16


# ------------------------------------------------------------------ words

def runs(docs: DataFrame, text: str = "text", least: int = 1, key: str = "doc_id") -> DataFrame:
    """A row per maximal run of Latin letters of at least ``least`` code points, A-Z lower-cased: ``key`` and run."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[a-z\\u00C0-\\u00FF]{{{int(least)},}}"), F.lit(0))
    return docs.select(F.col(key).alias("key"), F.explode(found).alias("run"))


def misspelt(words: DataFrame, every: int = 31) -> DataFrame:
    """``runs`` with a letter of every ``every``-th missing, as the crc32 of key and run says (column ``word``)."""
    h = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return words.select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, least: int = 7, often: int = 2) -> DataFrame:
    """The distinct words of at least ``least`` code points that occur ``often`` times or more: word, n."""
    return (words.where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= often))


# ------------------------------------------------------------------ the trie

def vectors(words: pa.Array, groups: int = GROUPS) -> np.ndarray:
    """Letters of each word in each group: one row a word."""
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4") % groups
    lengths = np.asarray(pc.utf8_length(words), np.int64)
    rows = np.repeat(np.arange(len(words)), lengths)
    return np.bincount(rows * groups + codes, minlength=len(words) * groups).reshape(-1, groups).astype(np.int32)


def edges(nodes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A number for each (node, count)."""
    return (nodes.astype(np.int64) << 32) + counts


def both_ends(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last three code points of each word as numbers; of words under six, which tell nothing, 0."""
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = np.asarray(pc.utf8_length(words), np.int64)
    ends = np.cumsum(lengths)
    long = np.nonzero(lengths >= 6)[0]
    first, last = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for k in range(3):
        first[long] = (first[long] << 21) | codes[(ends - lengths)[long] + k]
        last[long] = (last[long] << 21) | codes[ends[long] - 3 + k]
    return first, last


class _Within:
    """Words of a leaf by one of their ends: ranges of ``rows``, found by a binary search."""

    def __init__(self, leaf: np.ndarray, end: np.ndarray):
        self.ends, rank_ = np.unique(end, return_inverse=True)
        keys = edges(leaf, rank_)
        self.rows = np.argsort(keys, kind="stable")
        self.keys = keys[self.rows]

    def ranges(self, leaf: np.ndarray, end: np.ndarray):
        at = np.minimum(np.searchsorted(self.ends, end), len(self.ends) - 1)
        key = np.where(self.ends[at] == end, edges(leaf, at), -1)
        return np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, "right")


def _expanded(query, lo, hi, rows, block):
    """Pairs (query, row) of all rows in each query's range, in blocks."""
    n = hi - lo
    ends = np.cumsum(n)
    for at in range(0, int(ends[-1]) if len(ends) else 0, block):
        j = np.arange(at, min(at + block, int(ends[-1])))
        i = np.searchsorted(ends, j, "right")
        yield query[i], rows[lo[i] + j - (ends[i] - n[i])]


class Trie:
    """The trie of words: per level the (parent, count) of every node, sorted, so a child is a binary search.

    One edit leaves the first or the last three letters of a word of six or more as they are, so the words of a
    leaf are arranged by both.
    """

    def __init__(self, vecs: np.ndarray, first: np.ndarray, last: np.ndarray):
        order = np.lexsort(vecs.T[::-1])
        v = vecs[order]
        self.levels, node = [], np.zeros(len(v), np.int64)
        for d in range(v.shape[1]):
            e = edges(node, v[:, d])
            new = np.ones(len(e), bool)
            new[1:] = e[1:] != e[:-1]
            self.levels.append(e[new])
            node = np.cumsum(new) - 1
        leaf = np.empty(len(v), np.int64)
        leaf[order] = node
        self.first, self.short = first, bool((first == 0).any())
        self.all, self.by_first, self.by_last = _Within(leaf, np.zeros(len(v), np.int64)), _Within(leaf, first), _Within(leaf, last)

    def search(self, vecs, first, last, depth: int = 0, budget=None, block: int = BLOCK):
        """Candidates (row searched for, row of the trie, whether of one vector), in blocks.

        Of two vectors only the one that is less in their first difference finds the other: its first step
        aside must be the surplus.  ``budget`` is 3 with both steps left, 2 with the surplus gone, 0 with none;
        the levels above ``depth``, all of one node, are behind.
        """
        budget = np.full(len(vecs), 3, np.int8) if budget is None else budget
        stack = [(depth, q, np.zeros(len(q), np.int64), budget[q])
                 for q in np.array_split(np.arange(len(vecs)), max(1, len(vecs) // block))]
        while stack:
            d, query, node, budget = stack.pop()
            if d == len(self.levels):
                for same in (True, False):
                    of = (budget == 3) == same
                    for q, row in self._leaves(query[of], node[of], first, last, block):
                        yield q, row, same
                continue
            level, want, out = self.levels[d], vecs[query, d], []
            for more, needs, left in ((0, None, None), (1, 3, 2), (-1, 2, 0)):
                can = np.arange(len(query)) if needs is None else np.nonzero(budget == needs)[0]
                e = edges(node[can], want[can] + more)
                at = np.minimum(np.searchsorted(level, e), len(level) - 1)
                hit = level[at] == e
                out.append((query[can][hit], at[hit], budget[can][hit] if needs is None else np.full(int(hit.sum()), left, np.int8)))
            query, node, budget = (np.concatenate(c) for c in zip(*out))
            for i in range(0, len(query), block):
                stack.append((d + 1, query[i : i + block], node[i : i + block], budget[i : i + block]))

    def _leaves(self, query, leaf, first, last, block):
        nothing = np.zeros(len(query), np.int64)
        short = first[query] == 0
        lo, hi = self.all.ranges(leaf, nothing)
        yield from _expanded(query[short], lo[short], hi[short], self.all.rows, block)
        query, leaf, nothing = query[~short], leaf[~short], nothing[~short]
        yield from _expanded(query, *self.by_first.ranges(leaf, first[query]), self.by_first.rows, block)
        if self.short:
            yield from _expanded(query, *self.by_first.ranges(leaf, nothing), self.by_first.rows, block)
        for q, row in _expanded(query, *self.by_last.ranges(leaf, last[query]), self.by_last.rows, block):
            other = first[q] != self.first[row]
            yield q[other], row[other]


class Letters:
    """Words as rows of letters, from the left and from the right, to verify many pairs at once."""

    WIDE = 32

    def __init__(self, words: pa.Array):
        self.text = words.to_pylist()
        codes = np.frombuffer("".join(self.text).encode("utf-32-le"), "<u4")
        codes = codes.astype(np.uint8) if not len(codes) or codes.max() < 256 else codes
        self.n = np.asarray(pc.utf8_length(words), np.int64)
        starts, wide = np.cumsum(self.n) - self.n, np.arange(self.WIDE)
        inside = wide < np.minimum(self.n, self.WIDE)[:, None]
        spare = np.append(codes, np.zeros(1, codes.dtype))
        self.left = np.where(inside, spare[np.where(inside, starts[:, None] + wide, 0)], 0)
        self.right = np.where(inside, spare[np.where(inside, (starts + self.n - 1)[:, None] - wide, 0)], 0)

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words of each pair are one edit apart."""
        ok = np.zeros(len(a), bool)
        long = (self.n[a] > self.WIDE) | (self.n[b] > self.WIDE)
        for i in np.nonzero(long)[0]:
            ok[i] = one_edit(self.text[a[i]], self.text[b[i]])
        same = np.nonzero(~long & (self.n[a] == self.n[b]))[0]
        ok[same] = (self.left[a[same]] != self.left[b[same]]).sum(axis=1) == 1
        more = np.nonzero(~long & (np.abs(self.n[a] - self.n[b]) == 1))[0]
        x, y = a[more], b[more]
        kept = (self.left[x] != self.left[y]).argmax(axis=1) + (self.right[x] != self.right[y]).argmax(axis=1)
        ok[more] = kept >= np.minimum(self.n[x], self.n[y])
        return ok


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from ``a`` to ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    lo, hi = 0, len(a)  # the longest common prefix
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return a[lo + (len(a) == len(b)) :] == b[lo + 1 :]


# ------------------------------------------------------------------ shards

def heavy_nodes(words: DataFrame, shard_words: int, groups: int = GROUPS, step: int = 4) -> dict[bytes, int]:
    """Words below every node of more than ``shard_words``, a node being the counts of its path as 32-bit integers.

    A pass counts ``step`` levels below the heavy nodes known so far.
    """
    heavy: dict = {}
    for top in range(0, groups, step):
        known = frozenset(k for k in heavy if len(k) == 4 * top)
        if top and not known:
            break
        levels = range(0 if top == 0 else top + 1, min(top + step, groups) + 1)

        def prefixes(batches, top=top, known=known, levels=levels):
            for batch in batches:
                v = vectors(batch.column(0), groups)
                if top:
                    v = v[np.fromiter((r.tobytes() in known for r in np.ascontiguousarray(v[:, :top])), bool, len(v))]
                for d in levels if len(v) else ():
                    nodes, n = np.unique(v[:, :d], axis=0, return_counts=True) if d else (v[:1, :0], [len(v)])
                    yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in nodes], pa.binary()), pa.array(n, pa.int64())],
                                                     names=["node", "n"])

        nodes = words.select("word").mapInArrow(prefixes, "node binary, n long").groupBy("node").agg(F.sum("n").alias("n"))
        heavy |= {bytes(r["node"]): r["n"] for r in nodes.where(F.col("n") > shard_words).collect()}
    return heavy


def reached(vec, heavy: dict, shard_words: int):
    """Shards that a search for ``vec`` enters: (node, parts, budget left there); the one it is in leaves all (3)."""
    stack = [(0, b"", 3)]
    while stack:
        d, node, budget = stack.pop()
        n = heavy.get(node)
        if n is None or d == len(vec):
            yield node, -(-n // shard_words) if n else 1, budget
            continue
        c = vec[d]
        stack.append((d + 1, node + c.to_bytes(4, "little"), budget))
        if budget == 3:
            stack.append((d + 1, node + (c + 1).to_bytes(4, "little"), 2))
        elif budget == 2 and c:
            stack.append((d + 1, node + (c - 1).to_bytes(4, "little"), 0))


def _dealt(heavy: dict, shard_words: int, groups: int):
    """Rows of words to the shards they are in (``indexed``) or search."""
    def deal(batches):
        for batch in batches:
            words, n = batch.column(0), batch.column(1)
            for at in range(0, len(words), 4096):
                part, out = words.slice(at, 4096), []
                text = part.to_pylist()
                for i, vec in enumerate(vectors(part, groups).tolist()):
                    for node, parts, budget in reached(vec, heavy, shard_words):
                        own = zlib.crc32(text[i].encode()) % parts if budget == 3 else -1
                        out += [(i, node, p, p == own, budget) for p in range(parts)]
                rows, node, nr, own, budget = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.binary()), pa.array(nr, pa.int32()), pa.array(own, pa.bool_()), pa.array(budget, pa.int8()),
                     part.take(pa.array(rows, pa.int64())), n.slice(at, 4096).take(pa.array(rows, pa.int64()))],
                    names=["node", "part", "indexed", "budget", "word", "n"])

    return deal


def _searched(groups: int, block: int):
    """Near words of the words of a shard, as far as it knows: word, how many, the most frequent and its n."""
    def search(t: pa.Table) -> pa.Table:
        words = pa.concat_arrays(t["word"].chunks)
        n, budget, indexed = t["n"].to_numpy(), t["budget"].to_numpy(), np.nonzero(t["indexed"].to_numpy())[0]
        vecs, letters = vectors(words, groups), Letters(words)
        first, last = both_ends(words)
        whose, near = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(indexed):
            trie = Trie(vecs[indexed], first[indexed], last[indexed])
            for query, row, same in trie.search(vecs, first, last, len(t["node"][0].as_py()) // 4, budget, block):
                other = indexed[row]
                ok = letters.one_edit(query, other)
                whose.append(query[ok])
                near.append(other[ok])
                if not same:  # the other does not search this one
                    whose.append(other[ok])
                    near.append(query[ok])
        whose, near = np.concatenate(whose), np.concatenate(near)
        spelt = np.empty(len(words), np.int64)
        spelt[np.asarray(pc.sort_indices(words))] = np.arange(len(words))
        by = np.lexsort((spelt[near], -n[near], whose))
        whose, near = whose[by], near[by]
        tops = np.nonzero(np.diff(whose, prepend=-1))[0]
        return pa.table({"word": words.take(pa.array(whose[tops])), "n_near": pa.array(np.diff(tops, append=len(whose)), pa.int64()),
                         "best": words.take(pa.array(near[tops])), "best_n": pa.array(n[near[tops]], pa.int64())})

    return search


def near_words(words: DataFrame, shard_words: int = 20_000, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """Of every word of ``words`` (word, n; words are distinct) with a near one: word, n_near, best, best_n.

    ``words`` is read twice, so it should be a saved table.
    """
    heavy = heavy_nodes(words, shard_words, groups)
    dealt = words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(
        _dealt(heavy, shard_words, groups), "node binary, part int, indexed boolean, budget tinyint, word string, n long")
    found = dealt.groupBy("node", "part").applyInArrow(_searched(groups, block), "word string, n_near long, best string, best_n long")
    top = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top"))
            .select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n")))


def grouped(words: DataFrame, ratio: int = 10, **options) -> DataFrame:
    """``words`` (word, n; saved) with form, root, n_near and form_n.

    A word's form is its near word of largest n if that is ``ratio`` times the
    word's or more; its root is where its forms lead.
    """
    near = near_words(words, **options)
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = saved(words.join(near, "word", "left").select(
        "word", "n", F.when(is_form, F.col("best")).alias("form"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "word-forms")
    most = formed.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.floor(math.log(most, ratio) + 1e-9))  # the longest chain of forms there can be
    to = formed.where("form is not null").select("word", F.col("form").alias("to"))
    for _ in range(math.ceil(math.log2(steps))):
        on = to.select(F.col("word").alias("to"), F.col("to").alias("next"))
        to = saved(to.join(on, "to", "left").select("word", F.coalesce("next", "to").alias("to")), "word-roots")
    return (formed.join(to, "word", "left")
            .select("word", "n", "form", F.coalesce("to", "word").alias("root"), "n_near", "form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all ``documents`` with their forms: word, form, root, n, n_near, form_n."""
    words = misspelt(runs(table(spark, sf_dir, "documents"), least=7))
    return grouped(saved(counted(words), "words")).select("word", "form", "root", "n", "n_near", "form_n")
