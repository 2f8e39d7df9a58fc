"""Line dedup by an exact set-similarity join.

A line (between line feeds) is the set of its words, lower-cased (A-Z), split
at ASCII space.  Lines are ordered by (doc_id, line number).  A line goes if an
earlier line, kept or not, has a Jaccard similarity of ``threshold`` or more
with it.  Lines without a word always stay, and so do lines of fewer than
``min_tokens`` different words, if that is over 1.

Lines so short that one word more or less is too much (n / (n + 1) below
``threshold``, at 0.8 up to three words) are similar to equal sets only.  Their
first line of each set is found by a hash of the set: each task keeps its own
first, so a set that fills a third of all lines has a row a task in the shuffle.

The join of the others:

1. Word counts over all lines, in a table of fixed size (words share its
   buckets), give one order of all words, rarest first.
2. A line of n words emits its prefix, the n - ceil(t n) + 1 rarest ones, of
   which two similar lines share one (of one more, two).  A word that is not
   common is a key by itself; common words are keys in pairs, so no key gathers
   all lines that have one common word.  Rows carry the line's position, size, the key's
   place in the order, a hash of the whole set and a parity
   sketch of 64 or 128 bits.
3. Rows meet by key, in line order.  Lines of equal sets collapse to the first;
   the later ones are settled.  The others are compared after the length
   filter, the positional filter and the sketch (the number of differing bits
   is at most the size of the symmetric difference).  Each line names its
   closest earlier candidate of a key only, so a group of g near copies gives
   about g candidates, not g squared.
4. Candidates are verified on their whole sets.  Lines that fail and had more
   candidates name all of them in a second round, over their keys alone.

So the result is exact, up to collisions of 44-bit word hashes inside the
lines compared and of 64-bit hashes of equal short sets, whatever the sketch, the counts and the order are.  Only sizes
and sketches of lines are shuffled, and the word sets of lines that need
verification; bit tables of fixed size tell the scans which lines and keys
these are.

Defined results: null and empty texts stay as they are; null doc_ids come
last; every row is a document with a place of its own, so rows of one doc_id, or
of none, follow one another by a hash of their text and remove each other's lines;
of equal rows one keeps its lines; a document whose lines all go keeps an
empty text; columns beyond doc_id and text travel along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm.common import chunks, fresh_name, mix64, saved, table
from fileflow.operators.ordered import with_global_index

THRESHOLD = 0.8
MIN_TOKENS = 1
#: Words are 44 bits: their bucket in the counts (its rank stands for it in the order) and the rest of their hash.
COUNT_BITS, REST_BITS = 17, 27
WORD_BITS = COUNT_BITS + REST_BITS
#: Bits (log2) of the tables of wanted lines and keys.
WANTED_BITS = 24
#: Lines of more words have the wide sketch.
NARROW = 24
#: A word is common if its bucket holds over this many times the mean, and at least so many.
COMMON_SHARE, COMMON_LEAST = 8, 20_000
LAST = (1 << 63) - 1  # stands for a null doc_id
#: Sets of up to so many words are identified by whole word hashes, as nothing else tells them apart.
FEW = 4
#: Short sets whose first line a task holds at once.
HELD = 1 << 18
#: Bytes of text that are cut into words at once, and the most lines that are sorted at once.
PART, MOST_LINES = 1 << 18, 1 << (64 - WORD_BITS)
#: Bytes of a word in the sets that are shuffled, and in those that are compared first.
PACKED, SHORT = -(-WORD_BITS // 8), 2

ROWS = "key long, doc long, line int, n int, at int, bits long, cls long, more long"
FOUND = "kind int, doc long, line int, cls long, key long, xdoc long, xline int, xcls long, n int, at int, bits long, more long"

#: What a byte adds to a word's hash; capital letters add what small ones do.
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] += np.uint64(32)
_WORDLY = np.ones(256, bool)
_WORDLY[[9, 10, 11, 12, 13, 32]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64, remembered."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        with np.errstate(over="ignore"):
            got = np.full(max(n, 2 * PART), base, np.uint64)
            got[0] = 1
            got = np.cumprod(got, dtype=np.uint64)
        _POWERS[base] = got
    return got[:n]


def word_hashes(texts: pa.Array, places: bool = True):
    """(hash of every word, its document's place, its line number) of some texts, in order; without ``places`` hashes only.

    Works on the texts' bytes at once: a word's hash is the difference of
    running sums of byte * base^position, shifted to position 0, and mixed.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    if at[-1] == at[0]:
        return (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)) if places else np.zeros(0, np.uint64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]: at[-1]]
    at = at - at[0]
    inside = _WORDLY[data]
    # words begin and end where that changes, and between two texts
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    opens = at[:-1][(at[1:] > at[:-1]) & (at[:-1] > 0)]
    joints = opens[inside[opens] & inside[opens - 1]]
    ends = [[0]] * bool(inside[0]), [[len(data)]] * bool(inside[-1])
    turns = np.sort(np.concatenate([*ends[0], turns, joints, joints, *ends[1]])).astype(np.int64)
    start, end = turns[::2], turns[1::2]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * _powers(_BASE, len(data)), out=sums[1:])
        h = mix64((sums[end] - sums[start]) * _powers(_INVERSE, len(data))[start])
    if not places:
        return h
    breaks = np.flatnonzero(data == 10)
    doc = np.searchsorted(at, start, side="right") - 1
    line = np.searchsorted(breaks, start)
    return h, doc, line - np.searchsorted(breaks, at[:-1])[doc]


def words_of(h: np.ndarray, rank: np.ndarray | None) -> np.ndarray:
    """Words as numbers of ``WORD_BITS`` bits that sort by the rank of their bucket."""
    bucket = (h >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
    rest = (h & np.uint64((1 << REST_BITS) - 1)).astype(np.uint64)
    return ((bucket if rank is None else rank[bucket]).astype(np.uint64) << np.uint64(REST_BITS)) | rest


class Lines:
    """The word sets of all comparable lines of some texts, as flat arrays.

    ``words`` lists the lines' distinct words, by rank inside a line;
    ``first``/``n`` say where a line's words are; ``doc`` is the place of its
    text and ``line`` its number; ``cls`` identifies its set; ``bits`` and
    ``more`` are the set's parity sketch: 128 bits for lines of over ``NARROW``
    words, else folded into the first 64.
    """

    def __init__(self, texts: pa.Array, order, min_tokens: int, wanted=None):
        h, doc, line = word_hashes(texts)
        new = np.ones(len(h), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(h)))
        doc, line = doc[start], line[start]
        some = count >= min_tokens
        if wanted is not None:
            some &= wanted(doc, line)
        of = np.repeat(np.cumsum(some) - 1, count)
        keep = np.repeat(some, count)
        h, of, doc, line = h[keep], of[keep], doc[some], line[some]
        owner = of
        # unsorted words of a line are neighbours, so a cut between lines loses nothing
        cuts = np.searchsorted(of, np.arange(0, len(doc) + 1, MOST_LINES))
        parts = [self._sets(words_of(h[a:b], order and order[0]), of[a:b] - k * MOST_LINES, k * MOST_LINES)
                 for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(h)])) if b > a]
        self.words, of = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        n = np.bincount(of, minlength=len(doc))
        ok = n >= min_tokens
        self.words = self.words[ok[of]]
        self.n, self.doc, self.line = n[ok], doc[ok], line[ok]
        self.first = np.cumsum(self.n) - self.n
        self.cls = self.bits = self.more = np.zeros(0, np.int64)
        if len(self.n):
            own = n[owner] <= FEW
            few, by = h[own], owner[own]
            order_ = np.lexsort((few, by))
            few, by = few[order_], by[order_]
            new = np.ones(len(few), bool)
            new[1:] = (few[1:] != few[:-1]) | (by[1:] != by[:-1])
            whole = np.zeros(len(n), np.uint64)
            with np.errstate(over="ignore"):
                np.add.at(whole, by[new], mix64(few[new]))
            plain = self.words
            if order is not None:  # identities don't depend on the order
                plain = (order[1][(plain >> np.uint64(REST_BITS)).astype(np.int64)] << np.uint64(REST_BITS)) | (plain & np.uint64((1 << REST_BITS) - 1))
            mixed = mix64(plain + np.uint64(1))
            with np.errstate(over="ignore"):
                self.cls = (np.add.reduceat(mixed, self.first) + self.n.astype(np.uint64) + whole[ok]).astype(np.int64)
            bit = np.uint64(1) << (mixed >> np.uint64(58))
            half = (mixed >> np.uint64(57)) & np.uint64(1)
            low, high = (np.bitwise_xor.reduceat(np.where(half == k, bit, 0).astype(np.uint64), self.first).astype(np.int64) for k in (0, 1))
            self.bits, self.more = np.where(self.n > NARROW, low, low ^ high), np.where(self.n > NARROW, high, 0)

    @staticmethod
    def _sets(words: np.ndarray, of: np.ndarray, add: int):
        """Distinct words of each line, sorted: one sort of (line, word) in 64 bits."""
        both = np.sort((of.astype(np.uint64) << np.uint64(WORD_BITS)) | words)
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        both = both[new]
        return both & np.uint64((1 << WORD_BITS) - 1), (both >> np.uint64(WORD_BITS)).astype(np.int64) + add


def at_least(n, threshold: float):
    """ceil(threshold * n), safe against rounding."""
    return np.ceil(threshold * n - 1e-9)


def only_equal(n, threshold: float):
    """Whether a set of ``n`` words is similar to equal sets only: one more word is too much already."""
    return n * (1 - threshold) < threshold - 1e-9


class Firsts:
    """The first line of each short set among those a task has seen, as rows in the order of ``ROWS``.

    A line that is later than another one is settled at once; its row has the size 0.
    """

    def __init__(self):
        self.held, self.out = {}, []

    def add(self, ids: np.ndarray, lines: Lines, some: np.ndarray):
        cols = (ids[lines.doc[some]], lines.line[some], lines.cls[some], lines.n[some], lines.bits[some], lines.more[some])
        for doc, line, cls, *rest in zip(*(c.tolist() for c in cols)):
            this = (doc, line, rest)
            first = self.held.setdefault(cls, this)
            if first[:2] == this[:2]:
                continue
            if this[:2] < first[:2]:
                self.held[cls], this = this, first
            self.out.append((this[0], this[1], 0, 0, cls, 0))

    def rows(self, last: bool):
        """Columns of the rows to emit now: what is settled and, at the end or if they are too many, the firsts."""
        keys = [(doc * 1_000_003 + line) & LAST for doc, line, *_ in self.out]
        rows = [(key, doc, line, n, 1, bits, cls, more) for key, (doc, line, n, bits, cls, more) in zip(keys, self.out)]
        if last or len(self.held) > HELD:
            rows += [(cls, doc, line, n, 1, bits, cls, more) for cls, (doc, line, (n, bits, more)) in self.held.items()]
            self.held = {}
        self.out = []
        return list(zip(*rows))


def prefix_rows(lines: Lines, threshold: float, common_rank: int):
    """(line place, key, position of its rarest word, whether it is the line's first key) of all prefixes.

    Lines that are similar to equal sets only have none.
    """
    length = np.minimum(lines.n, (lines.n - at_least(lines.n, threshold)).astype(np.int64) + 2)
    length[only_equal(lines.n, threshold)] = 0
    of = np.repeat(np.arange(len(lines.n)), length)
    at = np.arange(len(of)) - np.repeat(np.cumsum(length) - length, length)
    key = lines.words[lines.first[of] + at]
    common = (key >> np.uint64(REST_BITS)).astype(np.int64) >= common_rank
    # one and two words may share a single word (at 0.5), so theirs are keys, common or not
    single = (at_least(lines.n, threshold) < 2)[of]
    plain = (~common & (at < np.maximum(length - 1, 1)[of])) | single
    out = [(of[plain], key[plain].astype(np.int64), at[plain])]
    of, key, at = of[common], key[common], at[common]
    for d in range(1, len(of)):  # pairs of common words of one line, d apart
        both = np.flatnonzero(of[d:] == of[:-d])
        if not len(both):
            break
        with np.errstate(over="ignore"):
            pair = mix64(key[both] * np.uint64(_BASE) + key[both + d])
        out.append((of[both], pair.astype(np.int64), at[both]))
    of, key, at = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(of, kind="stable")
    of, key, at = of[order], key[order], at[order]
    lead = np.ones(len(of), bool)
    lead[1:] = of[1:] != of[:-1]
    return of, key, at, lead


def _parts(batches):
    """(ids with null as last, texts) in parts of Arrow batches of about ``PART`` bytes of text."""
    for batch in batches:
        ids = pc.fill_null(batch.column(0), LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ids):
            done = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, done + PART, side="right")))
            yield ids[start:end], batch.column(1).slice(start, end - start)
            start = end


def word_ranks(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Rank of each bucket of words, rarest first, and the first rank that is common.

    The table has a fixed number of buckets, whatever the corpus holds.
    """
    size = 1 << COUNT_BITS

    def count(batches):
        total = np.zeros(size, np.int64)
        for _, texts in _parts(batches):
            h = word_hashes(texts, places=False)
            total += np.bincount((h >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    got = rows.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    order = np.argsort(counts, kind="stable")
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    least = max(COMMON_LEAST, COMMON_SHARE * counts.mean())
    return rank, int(np.searchsorted(counts[order], least, side="right"))


def _passes(n, at, bits, more, y, x, threshold: float):
    """Length, positional and sketch filter for rows y against x; and the differing bits of the sketches."""
    ny, nx = n[y], n[x]
    both = ny + nx
    need = at_least(both, threshold / (1 + threshold))
    most = np.minimum(ny - at[y], nx - at[x]) + np.minimum(at[y], at[x])
    low, high = bits[y] ^ bits[x], more[y] ^ more[x]
    apart = np.where(np.minimum(ny, nx) > NARROW, _ones(low) + _ones(high), _ones(low ^ high))
    ok = (np.minimum(ny, nx) >= at_least(np.maximum(ny, nx), threshold)) & (most >= need) & (apart <= both - 2 * need)
    return ok, apart


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).astype(np.int64)


def _blocks(batches):
    """Columns of rows sorted by key, in blocks of whole keys; equal sets of a key are collapsed as they come.

    Yields (rows that stay; settled rows): lists of arrays in the order of ``ROWS``.
    Rows of a key that stay are in the order of their sizes.
    """
    held = None
    for cols in _gathered(batches):
        cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
        cut = np.searchsorted(cols[0], cols[0][-1])  # the last key may go on
        whole, settled = _collapse([c[:cut] for c in cols])
        whole = _by_size(whole)
        held, more = [c[cut:] for c in cols], [c[:0] for c in cols]
        if len(held[0]) > 1:
            held, more = _collapse(held)
        yield whole, [np.concatenate(x) for x in zip(settled, more)]
    if held is not None and len(held[0]) > 1:
        yield _by_size(_collapse(held)[0]), [c[:0] for c in held]


def _by_size(cols):
    """Rows of a key in the order of their sizes."""
    group = np.cumsum(np.concatenate(([0], cols[0][1:] != cols[0][:-1]))) if len(cols[0]) else np.zeros(0, np.int64)
    order = np.argsort((group << 32) | cols[3])
    return [c[order] for c in cols]


def _gathered(batches, rows: int = 1 << 18):
    """Columns of Arrow batches as arrays of about ``rows`` rows."""
    some, n = [], 0
    for batch in batches:
        some.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)])
        n += batch.num_rows
        if n >= rows:
            yield [np.concatenate(x) for x in zip(*some)]
            some, n = [], 0
    if n:
        yield [np.concatenate(x) for x in zip(*some)]


def _collapse(cols):
    """The first row, in line order, of each key and set; and the later ones that are other lines than the first.

    Rows of keys that have one row only are dropped.  Those that stay are in no order inside a key.
    """
    key = cols[0]
    single = np.ones(len(key), bool)
    single[1:] &= key[1:] != key[:-1]
    single[:-1] &= key[1:] != key[:-1]
    cols = [c[~single] for c in cols]
    group = np.cumsum(np.concatenate(([0], cols[0][1:] != cols[0][:-1]))) if len(cols[0]) else np.zeros(0, np.int64)
    # one sort brings equal sets of a key together; bits of a set's hash do for that
    order = np.argsort((group.astype(np.uint64) << np.uint64(36)) | (cols[6].view(np.uint64) >> np.uint64(28)))
    cols = [c[order] for c in cols]
    key, doc, line, cls = cols[0], cols[1], cols[2], cols[6]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    if new.all():
        return cols, [c[:0] for c in cols]
    start = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    low = np.minimum.reduceat(doc, start)[of]
    least = np.minimum.reduceat(np.where(doc == low, line, np.iinfo(np.int32).max), start)[of]
    first = (doc == low) & (line == least)
    once = np.full(len(start), -1)
    at = np.flatnonzero(first)
    once[of[at]] = at  # one of equal rows
    return [c[once] for c in cols], [c[~first] for c in cols]


def _groups(key):
    """Place of each row in its key's group."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.arange(len(key)) - np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))


def _compared(cols, threshold: float, of=None):
    """(later rows y, earlier rows x, differing bits) of the pairs of a key that pass the filters.

    Rows of a key come by size, so each looks back only as far as the length
    filter allows; the folded sketch sorts out most of the rest.  ``of`` says
    which rows may be y's; all if it isn't given.
    """
    key, doc, line, n, at, bits, _, more = cols
    place, at = _groups(key), at >> 1
    folded = (bits ^ more).view(np.uint64)
    least = at_least(n, threshold)
    most = np.minimum(np.floor(2 * n * (1 - threshold) / (1 + threshold) + 1e-9), 64).astype(np.uint8)  # of 64 bits
    rows, d = np.flatnonzero(place >= 1), 1
    while len(rows):
        rows = rows[n[rows - d] >= least[rows]]
        near = rows[np.bitwise_count(folded[rows] ^ folded[rows - d]) <= most[rows]]
        ok, apart = _passes(n, at, bits, more, near, near - d, threshold)
        a, apart = near[ok], apart[ok]
        b = a - d
        later = (doc[a] > doc[b]) | ((doc[a] == doc[b]) & (line[a] > line[b]))
        y, x = np.where(later, a, b), np.where(later, b, a)
        ok = (doc[a] != doc[b]) | (line[a] != line[b])
        if of is not None:
            ok &= of[y]
        yield y[ok], x[ok], apart[ok]
        d += 1
        rows = rows[place[rows] >= d]


def first_round(threshold: float):
    """Per key: settled lines (kind 0), each line's closest candidate (1; kind 2: it has more of them; ``at`` has
    the differing bits of the sketches) and, where a line has more, the candidates' rows for a second look (3)."""

    def run(batches):
        early = []
        for cols, settled in _blocks(_unsettled(batches, early)):
            while early:
                yield early.pop()
            key, doc, line, n, at, bits, cls, more = cols
            lead = (settled[4] & 1) == 1
            if lead.any():
                yield _out(np.zeros(lead.sum()), settled[1][lead], settled[2][lead], settled[6][lead])
            best, nearest, seen = np.full(len(key), 1 << 30), np.full(len(key), -1), np.zeros(len(key), np.int64)
            named = np.zeros(len(key), bool)
            for y, x, apart in _compared(cols, threshold):
                np.add.at(seen, y, 1)  # a row may be later than one row and than another in the same step
                named[x] = True
                for y, x, apart in ((y[::-1], x[::-1], apart[::-1]), (y, x, apart)):
                    closer = apart < best[y]
                    best[y[closer]], nearest[y[closer]] = apart[closer], x[closer]
            y = np.flatnonzero(nearest >= 0)
            if len(y):
                x = nearest[y]
                yield _out(1 + (seen[y] > 1), doc[y], line[y], cls[y], key[y], doc[x], line[x], cls[x], None, best[y])
            again = (seen > 1) | (named & np.isin(key, key[seen > 1]))
            if again.any():
                yield _out(np.full(again.sum(), 3), *(c[again] for c in (doc, line, cls, key)), None, None, None,
                           *(c[again] for c in (n, at, bits, more)))
        yield from early

    return run


def _unsettled(batches, early: list):
    """The ``batches`` without the rows of size 0, which go to ``early`` as settled lines."""
    for batch in batches:
        settled = pc.equal(batch.column(3), 0)
        if pc.any(settled).as_py():
            doc, line, cls = (batch.column(i).filter(settled).to_numpy(zero_copy_only=False) for i in (1, 2, 6))
            early.append(_out(np.zeros(len(doc)), doc, line, cls))
            batch = batch.filter(pc.invert(settled))  # noqa: PLW2901
        if batch.num_rows:
            yield batch


def second_round(threshold: float, open_):
    """All candidates of the lines whose bit is in the table ``open_``."""

    def run(batches):
        for cols, _ in _blocks(batches):
            doc, line, cls = cols[1], cols[2], cols[6]
            for y, x, _ in _compared(cols, threshold, _has(open_.value, _line_bit(doc, line))):
                if len(y):
                    yield _out(np.ones(len(y)), doc[y], line[y], cls[y], None, doc[x], line[x], cls[x])

    return run


def _out(kind, *others):
    long, int_ = pa.int64(), pa.int32()
    kinds = [int_, long, int_, long, long, long, int_, long, int_, int_, long, long]
    cols = [kind.astype(np.int32), *others, *[None] * (len(kinds) - 1 - len(others))]
    cols = [pa.nulls(len(kind), k) if c is None else pa.array(c, k) for c, k in zip(cols, kinds)]
    return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in FOUND.split(", ")])


#: Bit of a line in a table of ``WANTED_BITS``; ``_line_bit`` is the same in numpy.
LINE_BIT = f"(pmod(doc, {1 << 20}L) * 1000003 + line) % {1 << WANTED_BITS}"


def _line_bit(doc, line):
    return ((doc % (1 << 20)) * 1_000_003 + line) % (1 << WANTED_BITS)


def _bit_table(lines: DataFrame) -> np.ndarray:
    """Table of fixed size with the bits of all ``lines``."""
    got = (lines.select(F.expr(LINE_BIT).alias("bit")).groupBy(F.expr("cast(bit div 32 as int)").alias("word"))
           .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits")).toPandas())
    out = np.zeros(1 << WANTED_BITS >> 5, np.int64)
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out


def _has(bits: np.ndarray, bit):
    return (bits[bit >> 5] >> (bit & 31)) & 1 == 1


def line_sets(rows: DataFrame, wanted: DataFrame, min_tokens: int) -> DataFrame:
    """(doc, line, cls, words) of the lines ``wanted`` and of the few that share their bits."""
    shared = rows.sparkSession.sparkContext.broadcast(_bit_table(wanted))

    def sets(batches):
        for ids, texts in _parts(batches):
            count = pc.add(pc.count_substring(pc.fill_null(texts, ""), "\n"), 1).to_numpy(zero_copy_only=False)
            first = np.cumsum(count) - count
            bit = _line_bit(np.repeat(ids, count), np.arange(count.sum()) - np.repeat(first, count))
            some = np.logical_or.reduceat(_has(shared.value, bit), first)
            if not some.any():
                continue
            ids, texts = ids[some], texts.filter(pa.array(some))
            lines = Lines(texts, None, min_tokens, lambda d, i: _has(shared.value, _line_bit(ids[d], i)))  # noqa: B023
            if len(lines.n):
                yield pa.RecordBatch.from_arrays([pa.array(ids[lines.doc]), pa.array(lines.line, pa.int32()), pa.array(lines.cls),
                                                  packed(lines.words, lines.n)], names=["doc", "line", "cls", "words"])

    return rows.mapInArrow(sets, "doc long, line int, cls long, words binary")


def packed(words: np.ndarray, n: np.ndarray, width: int = PACKED) -> pa.Array:
    """The words of lines of ``n`` words each as bytes, ``width`` a word."""
    data = words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(np.append(0, np.cumsum(n, dtype=np.int64) * width)),
                                                             pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def unpacked(lines: pa.Array, width: int = PACKED) -> tuple[np.ndarray, np.ndarray]:
    """(words, words a line) of ``packed`` lines.

    Words of fewer bytes may repeat in a line; they get the number of the repeat, so that sets share at least what whole words do.
    """
    n = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) // width
    words = np.zeros((int(n.sum()), 8), np.uint8)
    words[:, :width] = np.frombuffer(b"".join(lines.to_pylist()), np.uint8).reshape(-1, width)
    words = words.view("<u8").ravel().astype(np.uint64)
    if width < PACKED and len(words):
        both = np.sort((np.repeat(np.arange(len(n), dtype=np.uint64), n) << np.uint64(WORD_BITS)) | words)
        words = ((both & np.uint64((1 << WORD_BITS) - 1)) << np.uint64(WORD_BITS - 8 * width)) | _groups(both).astype(np.uint64)
    return words, n


def shared_words(a: pa.Array, b: pa.Array, width: int = PACKED) -> tuple[np.ndarray, np.ndarray]:
    """(words that two sets share, words in either) of lines beside each other; at most ``MOST_LINES``."""
    (x, nx), (y, ny) = unpacked(a, width), unpacked(b, width)
    of = np.concatenate([np.repeat(np.arange(len(n), dtype=np.uint64), n) for n in (nx, ny)])
    both = np.sort((of << np.uint64(WORD_BITS)) | np.concatenate([x, y]))
    twice = (both[1:][both[1:] == both[:-1]] >> np.uint64(WORD_BITS)).astype(np.int64)
    shared = np.bincount(twice, minlength=len(nx))
    return shared, nx + ny - shared


def shortened(lines: pa.Array, width: int) -> pa.Array:
    """``packed`` lines with the first ``width`` bytes of each word."""
    words, n = unpacked(lines)
    return packed(words, n, width)


def of_lines(sets: DataFrame, wanted: DataFrame, width: int = PACKED) -> DataFrame:
    """The rows of ``sets`` that are ``wanted`` lines, and the few that share their bits, words cut to ``width`` bytes; no shuffle."""
    shared = sets.sparkSession.sparkContext.broadcast(_bit_table(wanted))

    def some(batches):
        for batch in batches:
            bit = _line_bit(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(_has(shared.value, bit)))  # noqa: PLW2901
            yield batch if width == PACKED else pa.RecordBatch.from_arrays([*batch.columns[:3], shortened(batch.column(3), width)], names=batch.schema.names)

    return sets.mapInArrow(some, sets.schema)


def verified(pairs: DataFrame, sets: DataFrame, threshold: float, width: int = PACKED) -> DataFrame:
    """The ``pairs`` of lines that are similar enough on whole sets; with words cut to ``width`` bytes, those that may be."""
    # only the sets that a side needs are shuffled
    y = of_lines(sets, pairs.select("doc", "line"), width)
    x = of_lines(sets, pairs.select(F.col("xdoc").alias("doc"), F.col("xline").alias("line")), width)
    x = x.select(F.col("doc").alias("xdoc"), F.col("line").alias("xline"), F.col("cls").alias("xcls"), F.col("words").alias("xwords"))
    both = pairs.join(y, ["doc", "line", "cls"]).join(x, ["xdoc", "xline", "xcls"])
    ids = ["doc", "line", "cls", "xdoc", "xline", "xcls"]

    def similar(batches):
        for batch in batches:
            for part in chunks(batch):
                shared, union = shared_words(part.column(6), part.column(7), width)
                yield part.select(ids).filter(pa.array(shared >= at_least(union, threshold)))

    return both.select(*ids, "words", "xwords").mapInArrow(similar, "doc long, line int, cls long, xdoc long, xline int, xcls long")


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD, min_tokens: int = MIN_TOKENS, text: str = "text") -> DataFrame:
    """(doc, line, cls): the lines that go, by position and set; doc_ids are places of their own (``placed``)."""
    if not 0.5 <= threshold <= 1 or min_tokens < 1:
        raise ValueError("threshold must be 0.5 to 1 and min_tokens 1 at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col(text).alias("text"))
    rank, common = word_ranks(rows)
    sc = docs.sparkSession.sparkContext
    order = sc.broadcast((rank, np.argsort(rank).astype(np.uint64)))
    fields = [c.split()[0] for c in ROWS.split(", ")]

    def emit(batches):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        firsts = Firsts()
        batch = lambda cols: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=fields)
        for ids, texts in _parts(batches):
            lines = Lines(texts, order.value, min_tokens)
            if len(lines.n):
                firsts.add(ids, lines, only_equal(lines.n, threshold))
                if cols := firsts.rows(False):
                    yield batch(cols)
                of, key, at, lead = prefix_rows(lines, threshold, common)
                cols = [key, ids[lines.doc][of], lines.line[of], lines.n[of], at * 2 + lead, lines.bits[of], lines.cls[of], lines.more[of]]
                yield batch(cols)
        if cols := firsts.rows(True):
            yield batch(cols)

    def by_key(prefixes):
        return prefixes.repartition(F.col("key")).sortWithinPartitions("key")

    found = saved(by_key(rows.mapInArrow(emit, ROWS)).mapInArrow(first_round(threshold), FOUND), "line-candidates", "kind")
    ids, pair = ["doc", "line", "cls"], ["doc", "line", "cls", "xdoc", "xline", "xcls"]
    gone, named, again = found.where("kind = 0").select(*ids), found.where("kind in (1, 2)"), found.where("kind = 3")
    if named.isEmpty():
        return gone
    pairs = saved(named.groupBy(*pair).agg(F.min("at").alias("apart")), "line-pairs")
    wanted = pairs.select("doc", "line").union(pairs.select("xdoc", "xline")).union(again.select("doc", "line"))
    sets = saved(line_sets(rows, wanted, min_tokens), "line-sets")
    # the closest candidate of each line first: most lines need no other
    closest = pairs.groupBy(*ids).agg(F.min(F.struct("apart", "xdoc", "xline", "xcls")).alias("x")).select(*ids, "x.xdoc", "x.xline", "x.xcls")
    near = saved(verified(closest, sets, threshold).select(*ids).distinct(), "lines-near")
    # a line that is settled has no candidates, so these are apart
    gone = gone.union(near)
    rest = saved(pairs.join(near, ids, "left_anti").select(*pair), "lines-open")
    if rest.isEmpty():
        return gone
    open_ = sc.broadcast(_bit_table(rest.select("doc", "line")))
    more = by_key(again.select(*fields)).mapInArrow(second_round(threshold, open_), FOUND).select(*pair)
    more = saved(more.union(rest).distinct(), "line-candidates-2")
    # most of these fail already on short words, which don't miss any that are similar
    maybe = saved(verified(more, sets, threshold, SHORT), "lines-maybe")
    return gone.union(verified(maybe, sets, threshold).select(*ids).distinct())


def placed(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with every row's place in the order, in a column of the name returned.

    That is the doc_id; where some are null or repeat, the row's number by
    doc_id, hash of the text and row of a saved table.
    """
    place = fresh_name(docs, "_place")
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty():
        return docs.withColumn(place, F.col("doc_id").cast("long")), place
    row = fresh_name(docs, "_row")
    rows = saved(docs.withColumn(row, F.monotonically_increasing_id()), "line-rows")
    keys = rows.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64(text).alias("h"), F.col(row).alias("r"))
    at = with_global_index(keys, [F.col("d").asc_nulls_last(), "h", "r"], place).select(F.col("r").alias(row), place)
    return saved(rows.join(at, row).drop(row), "line-places"), place


def _by_document(gone: DataFrame) -> DataFrame:
    """One row per document that loses lines; a document's own lines bound the list."""
    return gone.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("line", "cls"))).alias("lines"))


def without_repeated_lines(docs: DataFrame, threshold: float = THRESHOLD, min_tokens: int = MIN_TOKENS, text: str = "text",
                           count: str | None = None) -> DataFrame:
    """``docs`` with the later matches gone from ``text``; with ``count``, how many went, in that column."""
    rows, place = placed(docs, text)
    gone = _by_document(removed_lines(rows.select(F.col(place).alias("doc_id"), text), threshold, min_tokens, text))
    lost, key = fresh_name(rows, "_lost"), fresh_name(rows, "_doc")
    joined = rows.join(gone.select(F.col("doc").alias(key), F.col("lines").alias(lost)), F.col(place) == F.col(key), "left").drop(key, place)
    own, at = docs.columns, docs.columns.index(text)
    width = len(own)
    schema = docs.schema if count is None else docs.withColumn(count, F.lit(0)).schema

    def cut(batches):
        for batch in batches:
            for part in chunks(batch):
                texts, lists = part.column(at).to_pylist(), part.column(width).to_pylist()
                out, numbers = [], []
                for t, lost in zip(texts, lists):
                    drop = set()
                    if t and lost:
                        mine = Lines(pa.array([t], pa.string()), None, min_tokens)
                        sets = dict(zip(mine.line.tolist(), mine.cls.tolist()))
                        drop = {x["line"] for x in lost if sets.get(x["line"]) == x["cls"]}
                        t = "\n".join(l for i, l in enumerate(t.split("\n")) if i not in drop) if drop else t
                    out.append(t)
                    numbers.append(len(drop))
                cols = dict(zip(own, part.columns[:width])) | {own[at]: pa.array(out, pa.string())}
                if count is not None:
                    cols[count] = pa.array(numbers, pa.int32())
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return joined.mapInArrow(cut, schema)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of all ``documents``: doc_id, n_lines, n_removed, removed (line numbers, ascending)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, place = placed(docs)
    gone = _by_document(removed_lines(rows.select(F.col(place).alias("doc_id"), "text")))
    size = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    lines = rows.select("doc_id", F.col(place).alias("doc"), size.alias("n_lines"))
    lost = F.coalesce(F.transform("lines", lambda x: x["line"]), F.array().cast("array<int>"))
    return lines.join(gone, "doc", "left").select("doc_id", "n_lines", F.size(lost).alias("n_removed"), lost.alias("removed"))
