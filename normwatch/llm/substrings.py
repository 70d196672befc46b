"""Passages that repeat across documents, exact or fuzzy, by collinear chaining of shared seeds.

There are two kinds of seeds.  Short ones are word 5-mers: all whose hash is among the lowest two
fifths, wherever they stand, and the least of every sixteen neighbours.  As the choice does not look
at the neighbours, a 5-mer between two edits is a seed in both documents or in none.  Long ones are
word 40-mers, the least of every eleven neighbours, so any shared run of fifty words shares one.

Occurrences of a seed are not paired with one another; each is matched with the first one, so rows
grow with the corpus.  The seeds of a passage may so be scattered over several documents that hold
parts of it earlier.  Hence both ends of a match of a long seed name the runs of fifty words around it
that are not the same in the other document, and those runs are matched like seeds in a second pass:
whoever shares a run is linked with the first holder of its long seed, or with one who named that run.
Seeds are first combined within a slice of documents (matched with the first occurrence there), so
that a passage found everywhere sends one row per slice through the shuffle.

Matches that no passage comes from are not the end either.  Where several documents share nothing
longer with the first holder of a seed, they may share it with each other.  Hence such a seed and
another one near it, matched elsewhere, make a seed of two, which is matched with its first holder in a
third pass.  Two seeds matched with one place make none.

The matches of two documents are chained: positions must increase in both, gaps cost in proportion
to their length, and a Fenwick tree finds the best predecessor.  Chains are cut at wide gaps, then
aligned word by word, extended at both ends, and cut to the stretches that score highest at +1 for a
match and -4 for anything else: an identity of at least 0.8.  Stretches that are too short by
that are extended while at least half of the words match, and kept if the whole still has 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from normwatch.llm.common import BROADCAST_BYTES, binary_text, in_arrow, sorted_runs, stored, table
from normwatch.llm.pretokens import text_slices

SEED_WORDS = 5
# Short seeds: hashes below this part of the range, and the least of so many neighbours.
SEED_SHARE = 0.4
WINDOW = 16
# Of a run of one word again and again every eighth 5-mer is a seed.
RUN_STEP = 8
MIN_WORDS = 50
# Of long seeds the least of so many neighbours is one; a run of MIN_WORDS words holds all of these.
LONG_WINDOW = 11
LONG_WORDS = MIN_WORDS - LONG_WINDOW + 1
IDENTITY = 0.8
# A chain is cut where its matches are further apart than this in either document.
MOST_GAP = 40
GAP_COST = 0.1
# Words looked at beyond both ends of a chain.
EXTENSION = 64
# A chain of short seeds with fewer matches is not aligned; one long seed is enough.
MIN_MATCHES = 2
_M = 0x9E3779B97F4A7C15


# Words that a Python worker remembers: none, as finding a word again takes longer than hashing it.
_HASHES: tuple[bytes, ...] = ()


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z taken as a-z; words end at white space."""
    words = text.lower().split()
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = hashes ^ (hashes >> np.uint64(29))
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(32))


def _short_places(seeds: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Positions of the short seeds among the hashes of all 5-mers that lie ``inside`` a document."""
    # Of a run of equal hashes only the first is chosen like others.
    again = np.concatenate([[False], seeds[1:] == seeds[:-1]])
    chosen = (seeds < np.uint64(int(SEED_SHARE * 2**64))) & ~again & inside
    order = np.where(again | ~inside, np.uint64(2**64 - 1), seeds)
    at = np.flatnonzero(chosen)
    # Every window without a chosen one has its least.
    bounds = np.concatenate([[-1], at, [len(seeds)]])
    for gap in np.flatnonzero(np.diff(bounds) > min(WINDOW, len(seeds))).tolist():
        begin, end = int(bounds[gap]) + 1, int(bounds[gap + 1])
        windows = np.lib.stride_tricks.sliding_window_view(order[begin:end], min(WINDOW, end - begin))
        chosen[begin + windows.argmin(axis=1) + np.arange(len(windows))] = True
    chosen &= ~again & inside
    if again.any():
        places = np.arange(len(seeds))
        since = places - np.maximum.accumulate(np.where(again, 0, places))
        chosen |= again & inside & (since % RUN_STEP == 0)
    return np.flatnonzero(chosen)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = pick(values[:-step], values[step:])
        size += step
    return values


def _long_places(seeds: np.ndarray) -> np.ndarray:
    """Positions that are the least of some window of neighbours."""
    if len(seeds) <= LONG_WINDOW:
        return np.array([int(seeds.argmin())])
    least = _sliding(seeds, LONG_WINDOW, np.minimum)
    # The largest of the minima of all windows around a position is its own hash if it is one of them.
    edge = np.zeros(LONG_WINDOW - 1, np.uint64)
    around = _sliding(np.concatenate([edge, least, edge]), LONG_WINDOW, np.maximum)
    return np.flatnonzero(around == seeds)


def _order(hashes: np.ndarray) -> np.ndarray:
    """The stable order of hashes."""
    # Sorting leading bits and places as one number is faster; places are right unless leading bits
    # of different hashes are equal.
    bits = np.uint64(max(1, len(hashes)).bit_length())
    packed = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ordered = hashes[order]
    if (ordered[1:] < ordered[:-1]).any():
        return np.argsort(hashes, kind="stable")
    return order


def _numbered(
    seeds: np.ndarray, at: np.ndarray, owner: np.ndarray, apart: int
) -> tuple[np.ndarray, np.ndarray]:
    """The second, third ... occurrence of a seed in a document is a seed of its own, so that text
    that repeats itself is matched in order.  They are also seeds without a number, so that any of
    them meets a single copy elsewhere.  Those less than ``apart`` after the last one are left out.
    """
    if not len(at):
        return seeds[at], at
    at = at[_order(seeds[at])]
    chosen, own = seeds[at], owner[at]
    begins = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (own[1:] != own[:-1])])
    if not begins.all() and apart > 1:
        far = begins | np.concatenate([[True], np.diff(at) >= apart])
        at, chosen, begins = at[far], chosen[far], begins[far]
    count = (np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]).astype(np.uint64)
    more = count > 0
    numbered = chosen ^ (count * np.uint64(0xD6E8FEB86659FD93))
    return np.concatenate([numbered, chosen[more]]), np.concatenate([at, at[more]])


def _run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, of which there must be one; equal wherever the run stands."""
    number = len(hashes) - size + 1
    # Sums of words times powers; the difference of two of them, times the inverse power, does not
    # depend on where the words stand.
    powers, inverse = (
        np.multiply.accumulate(np.append(np.uint64(1), np.full(len(hashes) - 1, m, np.uint64)))
        for m in (_M, pow(_M, -1, 2**64))
    )
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers)])
    return _mixed((sums[size:] - sums[:-size]) * inverse[:number])


def seeds_of(
    hashes: np.ndarray, owner: np.ndarray | None = None, long_words: int = MIN_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and marks of the seeds of a document; a mark is twice the position, plus 1 if long.

    The words may be those of several documents, one after the other; ``owner`` numbers the document
    of each word then.  Long seeds have ``long_words`` words.
    """
    number = len(hashes) - SEED_WORDS + 1
    if number < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if owner is None:
        owner = np.zeros(len(hashes), np.int32)
    short = np.zeros(number, np.uint64)
    for i in range(SEED_WORDS):
        short = short * np.uint64(_M) + hashes[i : i + number]
    inside = owner[SEED_WORDS - 1 :] == owner[:number]
    # What lies between two documents differs from place to place.
    short = _mixed(np.where(inside, short, np.arange(number, dtype=np.uint64)))
    seeds, at = _numbered(short, _short_places(short, inside), owner, 1)
    number = len(hashes) - long_words + 1
    if number < 1:
        return seeds, 2 * at
    long = _run_hashes(hashes, long_words)
    inside = owner[long_words - 1 :] == owner[:number]
    where = _long_places(np.where(inside, long, np.uint64(2**64 - 1)))
    more, where = _numbered(long, where[inside[where]], owner, LONG_WINDOW)
    return np.concatenate([seeds, more]), np.concatenate([2 * at, 2 * where + 1])


# A match made within a slice has no seed, but its mark (``of``, see ``_mark``).
_SEEDS = "seed long, doc long, pos int, other long, other_pos int, of int"


def _mark(seed: np.ndarray) -> np.ndarray:
    """Half the bits of seeds, enough to tell which matches come from the same one."""
    return (seed >> 32).astype(np.int32)


def _seed_rows(seed, doc, pos, other, other_pos, of) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(seed, pa.int64()),
            pa.array(doc, pa.int64()),
            pa.array(pos, pa.int32()),
            pa.array(other, pa.int64()),
            pa.array(other_pos, pa.int32()),
            pa.array(of, pa.int32()),
        ],
        names=["seed", "doc", "pos", "other", "other_pos", "of"],
    )


def _nothing(count: int, kind: pa.DataType) -> pa.Array:
    return pa.nulls(count, kind)


def _paired(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray):
    """Begin of the last seed, the rows of each seed's first document, and the pairs with their marks.

    Rows are sorted by seed, and those of its least doc begin.  Those of other documents are paired with the first row
    of the seed, and further rows of the first document with the first row of another one.
    """
    first = np.concatenate([[True], seed[1:] != seed[:-1]])
    starts, number = np.flatnonzero(first), np.cumsum(first) - 1
    run = starts[number]
    holder = doc == doc[run]
    others = np.flatnonzero(~holder)
    runs, at = np.unique(number[others], return_index=True)
    second = np.full(len(starts), -1)
    second[runs] = others[at]
    again = np.flatnonzero(holder & ~first & (second[number] >= 0))
    a = np.concatenate([others, second[number[again]]])
    b = np.concatenate([run[others], again])
    return int(starts[-1]), holder, (doc[a], pos[a], doc[b], pos[b], _mark(seed[a]))


def _collect_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first document of every seed in a slice, and matches of the others with it."""
    for batch in batches:
        for part in text_slices(batch, 1):
            texts = sorted(zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
            hashed = [(doc, word_hashes(text)) for doc, text in texts]
            hashed = [(doc, words) for doc, words in hashed if len(words) >= MIN_WORDS]
            if not hashed:
                continue
            sizes = [len(words) for _, words in hashed]
            owner = np.repeat(np.arange(len(hashed), dtype=np.int32), sizes)
            seed, marks = seeds_of(np.concatenate([words for _, words in hashed]), owner, LONG_WORDS)
            order = _order(seed)
            seed, marks = seed[order].view(np.int64), marks[order]
            own = owner[marks >> 1]
            doc = np.array([doc for doc, _ in hashed])[own]
            yield from _slice_rows(seed, doc, marks - 2 * (np.cumsum(sizes) - sizes)[own])


def _slice_rows(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a slice sends on: rows of the first document of every seed, and matches of the others with it."""
    _, holder, pairs = _paired(seed, doc, pos)
    n, m = int(holder.sum()), len(pairs[0])
    yield _seed_rows(
        seed[holder], doc[holder], pos[holder], *[_nothing(n, k) for k in (pa.int64(), pa.int32(), pa.int32())]
    )
    if m:
        yield _seed_rows(_nothing(m, pa.int64()), *pairs)


def _collect_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first document of every named run in a batch, and matches of the others with it."""
    for batch in batches:
        if batch.num_rows:
            seed, doc, pos = (batch.column(n).to_numpy() for n in ("seed", "doc", "pos"))
            order = np.lexsort((pos, doc, seed))
            seed, doc, pos = seed[order], doc[order], pos[order]
            again = (seed[1:] == seed[:-1]) & (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1])
            once = np.concatenate([[True], ~again])
            yield from _slice_rows(seed[once], doc[once], pos[once])


def _match_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches made before, which have no seed and come first, and those of the others.

    The others are sorted by seed, doc and pos; those of a seed are matched as in ``_paired``.
    """
    names = ["doc", "pos", "other", "other_pos", "of"]
    last: list[np.ndarray] | None = None
    for batch in batches:
        made = batch.column("seed").null_count
        if made:
            yield batch.select(names).slice(0, made)
            batch = batch.slice(made)
        if not batch.num_rows:
            continue
        rows = [batch.column(i).to_numpy() for i in range(3)]
        if last is not None:
            rows = [np.concatenate(c) for c in zip(last, rows)]
        seed, doc, pos = rows
        begin, holder, pairs = _paired(seed, doc, pos)
        # All rows of the first document wait for another one; then the first of them is enough.
        end = len(seed) if holder[-1] else begin + 1
        last = [c[begin:end].copy() for c in rows]
        if len(pairs[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(k)) for c, k in zip(pairs, (*(np.int64, np.int32) * 2, np.int32))],
                names=names,
            )


def chain_matches(x: np.ndarray, y: np.ndarray, long: np.ndarray | None = None) -> list[np.ndarray]:
    """Chains of matches, as lists of their numbers, best first; every match is in one at most.

    Chains with fewer than ``MIN_MATCHES`` are left out, unless they hold a ``long`` match.

    A match scores the words of a seed.  Following match j with match i costs ``GAP_COST`` times
    the distance in both documents, so the best predecessor is the one with the largest
    score + GAP_COST * (x + y) among those with smaller x and y: a prefix maximum over y in a Fenwick
    tree, as matches are taken in order of x.  A finished chain is cut wherever it skips more than
    ``MOST_GAP`` words, so two passages far from each other stay two, and a match between them costs
    neither.
    """
    # Of equal x the largest y comes first, so that none of them follows another.
    order = np.lexsort((-y, x))
    by_y = np.argsort(y)
    steps, rank = np.ones(len(y), np.int64), np.empty(len(y), np.int64)
    steps[1:] = y[by_y[1:]] != y[by_y[:-1]]
    rank[by_y] = np.cumsum(steps)
    size = int(steps.sum())
    xs, ys, ranks = x.tolist(), y.tolist(), rank.tolist()
    score = [0.0] * len(xs)
    before = [-1] * len(xs)
    largest, holder = [0.0] * (size + 1), [-1] * (size + 1)
    for i in order.tolist():
        place = GAP_COST * (xs[i] + ys[i])
        best, match = place, -1
        at = ranks[i] - 1
        while at > 0:
            if largest[at] > best:
                best, match = largest[at], holder[at]
            at &= at - 1
        score[i] = SEED_WORDS + best - place
        before[i] = match
        value, at = SEED_WORDS + best, ranks[i]
        while at <= size:
            if value > largest[at]:
                largest[at], holder[at] = value, i
            at += at & -at
    used = [False] * len(xs)
    longs = set(np.flatnonzero(long).tolist()) if long is not None else set()
    chains = []

    def keep(chain: list[int]) -> None:
        if len(chain) >= MIN_MATCHES or (longs and not longs.isdisjoint(chain)):
            chains.append(np.array(chain[::-1]))

    for i in sorted(range(len(xs)), key=score.__getitem__, reverse=True):
        if used[i]:
            continue
        chain: list[int] = []
        while i >= 0 and not used[i]:
            used[i] = True
            if chain:
                last = chain[-1]
                if xs[last] - xs[i] > MOST_GAP or ys[last] - ys[i] > MOST_GAP:
                    keep(chain)
                    chain = []
            chain.append(i)
            i = before[i]
        keep(chain)
    return chains


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by doc and other; one row per chain with its anchors, ``xs`` as marks.

    A match that is in no chain is a row without anchors, with its positions and ``of``.
    """
    for _, rows in sorted_runs(batches, ["doc", "other"], 1 << 26):
        doc, other = rows.column("doc").to_numpy(), rows.column("other").to_numpy()
        x, y = rows.column("pos").to_numpy(), rows.column("other_pos").to_numpy()
        of = rows.column("of").to_numpy()
        change = np.flatnonzero((doc[1:] != doc[:-1]) | (other[1:] != other[:-1])) + 1
        starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(doc)]])
        wanted = (ends - starts >= MIN_MATCHES) | (x[starts] & 1 == 1)
        marks = (x.astype(np.int64) >> 1 << 32) | y
        alone = np.repeat(~wanted, ends - starts)
        out: list[list] = [[] for _ in range(9)]
        for begin, end in zip(starts[wanted].tolist(), ends[wanted].tolist()):
            # Marks to positions, each pair once and long if any of its matches is.
            order = np.argsort(marks[begin:end], kind="stable")
            both = marks[begin:end][order]
            last_of = np.ones(len(both), bool)
            last_of[:-1] = both[1:] >> 1 != both[:-1] >> 1
            both, at = both[last_of], begin + order[last_of]
            a, b, long = both >> 32, (both & 0xFFFFFFFF) >> 1, (both & 1).astype(bool)
            alone[at] = True
            for chain in chain_matches(a, b, long):
                alone[at[chain]] = False
                out[0].append(doc[begin])
                out[1].append(other[begin])
                out[2].append((2 * a[chain] + long[chain]).astype(np.int32).tobytes())
                out[3].append(b[chain].astype(np.int32).tobytes())
                out[4].append(of[at[chain]].tobytes())
                for column, value in zip(out[5:], (a[chain[0]], a[chain[-1]], b[chain[0]], b[chain[-1]])):
                    column.append(value)
        names = ["doc", "other", "xs", "ys", "ofs", "x_from", "x_to", "y_from", "y_to", "of"]
        if out[0]:
            first, last, o_first, o_last = out[5:]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    *[pa.array(c, pa.binary()) for c in out[2:5]],
                    *[
                        pa.array(np.maximum(0, np.array(v) + shift).astype(np.int32))
                        for v, shift in (
                            (first, -EXTENSION),
                            (last, SEED_WORDS + EXTENSION),
                            (o_first, -EXTENSION),
                            (o_last, SEED_WORDS + EXTENSION),
                        )
                    ],
                    _nothing(len(out[0]), pa.int32()),
                ],
                names=names,
            )
        if alone.any():
            n, kinds = int(alone.sum()), (pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[alone]),
                    pa.array(other[alone]),
                    *[_nothing(n, kinds[0])] * 3,
                    pa.array(x[alone] >> 1),
                    _nothing(n, kinds[1]),
                    pa.array(y[alone] >> 1),
                    _nothing(n, kinds[1]),
                    pa.array(of[alone]),
                ],
                names=names,
            )


_CHAINS = (
    "doc long, other long, xs binary, ys binary, ofs binary, x_from int, x_to int, y_from int, y_to int, "
    "of int"
)


def _cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of the wanted spans of each text.

    Rows are sorted by doc and begin: those without a begin hold the text of a document, the others
    a span of it.  Of several texts of a document the last one counts.
    """
    doc, text, hashes = None, b"", None
    for batch in batches:
        out: list[list] = [[], [], [], []]
        ids, begins, ends = (batch.column(n).to_pylist() for n in ("doc", "begin", "end"))
        for i, begin in enumerate(begins):
            if begin is None:
                doc, text, hashes = ids[i], batch.column("text")[i].as_py(), None
            elif ids[i] == doc:
                if hashes is None:
                    hashes = (word_hashes(text) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                for column, value in zip(out, (doc, begin, ends[i], hashes[begin : ends[i]].tobytes())):
                    column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds)], names=["doc", "begin", "end", "words"]
        )


def _gap_columns(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Aligned columns of two short stretches: steps in a, steps in b, and whether they match.

    Words are compared from the left up to a split and from the right after it; the split with the
    most matches wins, and the surplus of the longer stretch is one gap there.
    """
    short = min(len(a), len(b))
    if len(a) == len(b):
        return np.ones(short, int), np.ones(short, int), a == b
    left = np.concatenate([[0], np.cumsum(a[:short] == b[:short])])
    right = np.concatenate([np.cumsum((a[len(a) - short :] == b[len(b) - short :])[::-1])[::-1], [0]])
    split = int(np.argmax(left + right))
    surplus = abs(len(a) - len(b))
    one = np.ones(short, int)
    gap = np.zeros(surplus, int)
    full = np.ones(surplus, int)
    da = np.concatenate([one[:split], full if len(a) > len(b) else gap, one[split:]])
    db = np.concatenate([one[:split], full if len(b) > len(a) else gap, one[split:]])
    hit = np.concatenate(
        [
            a[:split] == b[:split],
            np.zeros(surplus, bool),
            a[len(a) - short + split :] == b[len(b) - short + split :],
        ]
    )
    return da, db, hit


def _reach(hit: np.ndarray) -> int:
    """Length of the beginning that has the most matches beyond those that do not match."""
    gain = np.concatenate([[0], np.cumsum(np.where(hit, 1, -1))])
    return int(np.argmax(gain))


def align_chain(
    a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, a_from: int, b_from: int
) -> list[tuple[int, int, int, int, float]]:
    """Passages (from, to, other from, other to, identity) along a chain of anchors x, y.

    ``a`` and ``b`` are the words of both documents from ``a_from`` and ``b_from`` on.
    """
    x, y = x - a_from, y - b_from
    x0, y0 = int(x[0]), int(y[0])
    reach = min(EXTENSION, x0, y0)
    # Anchors on one diagonal are compared in one piece.
    shift = x - y
    turn = np.flatnonzero(shift[1:] != shift[:-1]).tolist()
    begin = turn[-1] + 1 if turn else 0
    rest = min(int(x[-1]) + SEED_WORDS + EXTENSION - int(x[begin]), len(a) - int(x[begin]), len(b) - int(y[begin]))
    if turn or rest < 0:
        parts = [_gap_columns(a[x0 - reach : x0], b[y0 - reach : y0])]
        begin = 0
        for t in turn:
            parts.append(_gap_columns(a[x[begin] : x[t]], b[y[begin] : y[t]]))
            parts.append(_gap_columns(a[x[t] : x[t + 1]], b[y[t] : y[t + 1]]))
            begin = t + 1
        parts.append(_gap_columns(a[x[begin] : x[begin] + rest], b[y[begin] : y[begin] + rest]))
        da, db, hit = (np.concatenate([p[i] for p in parts]) for i in range(3))
    else:
        hit = a[x0 - reach : x0 + rest] == b[y0 - reach : y0 + rest]
        da = db = np.ones(len(hit), int)
    # No passage has fewer matches than this.
    least = IDENTITY * MIN_WORDS
    if np.count_nonzero(hit) < least:
        return []
    ax = a_from + x0 - reach + np.concatenate([[0], np.cumsum(da)])
    by = b_from + y0 - reach + np.concatenate([[0], np.cumsum(db)])
    found = []
    todo = [(0, len(hit))]
    while todo:
        low, high = todo.pop()
        if high - low < MIN_WORDS or np.count_nonzero(hit[low:high]) < least:
            continue
        gain = np.concatenate([[0.0], np.cumsum(np.where(hit[low:high], 1.0, -IDENTITY / (1 - IDENTITY)))])
        floor = np.minimum.accumulate(gain)
        end = int(np.argmax(gain - floor))
        begin = int(np.argmin(gain[: end + 1]))
        if end <= begin:
            continue
        begin, end = low + begin, low + end
        if min(ax[end] - ax[begin], by[end] - by[begin]) < MIN_WORDS:
            # Edits near the ends cut short passages off: both ends go on while they match by half.
            begin -= _reach(hit[low:begin][::-1])
            end += _reach(hit[end:high])
        length = min(ax[end] - ax[begin], by[end] - by[begin])
        same = float(hit[begin:end].sum() / (end - begin))
        if length >= MIN_WORDS and same >= IDENTITY:
            found.append((int(ax[begin]), int(ax[end]), int(by[begin]), int(by[end]), same))
        todo += [(low, begin), (end, high)]
    return found


def equal_runs(
    a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray
) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """Around long seeds at x, y: what is equal, and where runs of ``MIN_WORDS`` words differ.

    Returns (from, to, other from) of equal stretches of at least ``MIN_WORDS`` words, and in both
    documents the beginnings of runs that hold a seed and are not equal to the run at the same
    place of the other one.
    """
    found, mine, theirs = [], [], []
    for shift in np.unique(x - y).tolist():
        at = x[x - y == shift]
        low, high = max(0, shift), min(len(a), len(b) + shift)
        at = at[(at >= low) & (at < high)]
        unlike = low + np.flatnonzero(a[low:high] != b[low - shift : high - shift])
        unlike = np.concatenate([[low - 1], unlike, [high]])
        after = np.searchsorted(unlike, at)
        begin, end = unlike[after - 1] + 1, unlike[after]
        # Of several texts of one document only one is read; a seed of another one is no seed there.
        real = end - at >= LONG_WORDS
        at, begin, end = at[real], begin[real], end[real]
        found += {(s, e, s - shift) for s, e in zip(begin.tolist(), end.tolist()) if e - s >= MIN_WORDS}
        runs = at[:, None] - np.arange(LONG_WINDOW)
        runs = np.unique(runs[(runs < begin[:, None]) | (runs > end[:, None] - MIN_WORDS)])
        mine.append(runs[(runs >= 0) & (runs <= len(a) - MIN_WORDS)])
        theirs.append(runs[(runs >= shift) & (runs - shift <= len(b) - MIN_WORDS)] - shift)
    return found, np.concatenate(mine), np.concatenate(theirs)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages, which have no seed, runs to be matched in the second pass, which have no other
    document, and both ends of the matches that are in no passage, either with the place in the other
    document."""
    names = ["doc", "other", "xs", "ys", "ofs", "x_from", "y_from", "a", "b"]
    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        named: list[list[np.ndarray]] = [[], [], []]
        left: list[list[np.ndarray]] = [[] for _ in range(5)]
        for doc, other, marks, ys, ofs, x_from, y_from, a, b in zip(
            *[batch.column(n).to_pylist() for n in names]
        ):
            a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
            marks = np.frombuffer(marks, np.int32).astype(np.int64)
            x, y = marks >> 1, np.frombuffer(ys, np.int32).astype(np.int64)
            passages = align_chain(a, b, x, y, x_from, y_from)
            long = marks & 1 == 1
            if long.any():
                equal, mine, theirs = equal_runs(a, b, x[long] - x_from, y[long] - y_from)
                # An alignment may leave the diagonal of a seed too early.
                for begin, end, o_begin in equal:
                    begin, end, o_begin = x_from + begin, x_from + end, y_from + o_begin
                    if not any(p[0] <= begin and end <= p[1] for p in passages):
                        passages.append((begin, end, o_begin, o_begin + end - begin, 1.0))
                for whose, start, span, runs in ((doc, x_from, a, mine), (other, y_from, b, theirs)):
                    if len(runs):
                        named[0].append(_run_hashes(span.astype(np.uint64), MIN_WORDS)[runs].view(np.int64))
                        named[1].append(np.full(len(runs), whose))
                        named[2].append(2 * (start + runs) + 1)
            free = np.ones(len(x), bool)
            for passage in passages:
                free &= (x < passage[0]) | (x >= passage[1])
            if free.any():
                n, of = int(free.sum()), np.frombuffer(ofs, np.int32)[free]
                for whose, at in ((doc, x[free]), (other, y[free])):
                    parts = (of, np.full(n, whose), at, np.full(n, other), y[free])
                    for column, part in zip(left, parts):
                        column.append(part)
            for passage in passages:
                for column, value in zip(out, (doc, passage[0], passage[1], other, *passage[2:])):
                    column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
        columns = ["doc_id", "begin_word", "end_word", "other_doc_id", "other_begin", "other_end", "identity"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds)] + [_nothing(len(out[0]), pa.int64())],
            names=[*columns, "seed"],
        )
        if named[0]:
            seed, doc, pos = map(np.concatenate, named)
            rest = [_nothing(len(seed), k) for k in kinds[2:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(pos, pa.int32()), *rest, pa.array(seed, pa.int64())],
                names=[*columns, "seed"],
            )
        if left[0]:
            of, doc, pos, other, other_pos = map(np.concatenate, left)
            none = [_nothing(len(of), k) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(pos, pa.int32()),
                    none[2],
                    pa.array(other, pa.int64()),
                    pa.array(other_pos, pa.int32()),
                    *none[5:],
                    pa.array(of, pa.int64()),
                ],
                names=[*columns, "seed"],
            )


def _compounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of two, of ends of matches that no passage came from; rows are sorted by doc and pos.

    Two ends make one if they are near each other without sharing words, one of them at least is
    ``contested``, and they were not compared with one and the same place already.  Either position
    gets a seed of its own.
    """
    for _, rows in sorted_runs(batches, ["doc"], 1 << 22):
        columns = ("doc", "pos", "seed", "rep", "rep_pos", "contested")
        doc, pos, seed, rep, rep_pos, contested = (rows.column(n).to_numpy() for n in columns)
        seed = seed.astype(np.uint64)
        for step in range(1, len(doc)):
            gap = pos[step:] - pos[:-step]
            near = (doc[step:] == doc[:-step]) & (gap <= MOST_GAP)
            if not near.any():
                break
            i = np.flatnonzero(near & (gap >= SEED_WORDS) & (contested[step:] | contested[:-step]))
            j = i + step
            gap = rep_pos[j] - rep_pos[i]
            apart = (seed[i] != seed[j]) & ((rep[j] != rep[i]) | (gap <= 0) | (gap > MOST_GAP))
            i, j = i[apart], j[apart]
            both = _mixed(seed[i] * np.uint64(_M) + seed[j])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([both, _mixed(both + np.uint64(1))]).view(np.int64)),
                    pa.array(np.tile(doc[i], 2)),
                    pa.array(2 * np.concatenate([pos[i], pos[j]])),
                ],
                names=["seed", "doc", "pos"],
            )


def _matches(seeds: DataFrame) -> DataFrame:
    """Matches of all occurrences of a seed with its first one, from what slices send on."""
    # Matches made within a slice pass through the exchange of the seeds, dealt by their documents.
    seeds = seeds.repartition(F.coalesce("seed", F.xxhash64("doc", "other")))
    seeds = seeds.sortWithinPartitions("seed", "doc", "pos")
    return in_arrow(seeds, _match_first, "doc long, pos int, other long, other_pos int, of int")


def _aligned(matches: DataFrame, rows: DataFrame) -> DataFrame:
    """What ``_align`` makes of the chains of matches and the texts of ``rows``."""
    matches = matches.repartition("doc", "other").sortWithinPartitions("doc", "other", "pos", "other_pos", "of")
    made = stored(in_arrow(matches, _chains, _CHAINS), "chains")
    chains = made.where("xs is not null")
    spans = chains.select(
        F.explode(
            F.array(
                F.struct(F.col("doc").alias("d"), F.col("x_from").alias("b"), F.col("x_to").alias("e")),
                F.struct(F.col("other").alias("d"), F.col("y_from").alias("b"), F.col("y_to").alias("e")),
            )
        ).alias("s")
    ).select("s.*")
    spans = stored(spans.distinct(), "spans")
    # A text goes once to the task that cuts all its spans; texts without any are left out where the
    # documents that have some are few enough to be sent to all.
    ids = stored(spans.select(F.col("d").alias("doc_id")).distinct(), "span_ids")
    if ids.count() * 24 <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    texts = rows.selectExpr("doc_id as doc", "cast(null as int) as begin", "cast(null as int) as end", "text")
    spans = spans.selectExpr("d as doc", "b as begin", "e as end", "cast(null as binary) as text")
    sorted_spans = texts.union(spans).repartition("doc").sortWithinPartitions("doc", "begin", "text", "end")
    cut = stored(in_arrow(sorted_spans, _cut_spans, "doc long, begin int, end int, words binary"), "words")
    a = cut.select(F.col("doc").alias("ad"), F.col("begin").alias("ab"), F.col("end").alias("ae"), F.col("words").alias("a"))
    b = cut.select(F.col("doc").alias("bd"), F.col("begin").alias("bb"), F.col("end").alias("be"), F.col("words").alias("b"))
    joined = chains.join(
        a, (F.col("doc") == F.col("ad")) & (F.col("x_from") == F.col("ab")) & (F.col("x_to") == F.col("ae"))
    ).join(
        b, (F.col("other") == F.col("bd")) & (F.col("y_from") == F.col("bb")) & (F.col("y_to") == F.col("be"))
    )
    aligned = in_arrow(
        joined.select("doc", "other", "xs", "ys", "ofs", "x_from", "y_from", "a", "b"),
        _align,
        "doc_id long, begin_word int, end_word int, other_doc_id long, other_begin int, other_end int, "
        "identity double, seed long",
    )
    ends = (
        "inline(array(struct(doc as doc_id, x_from as begin_word), struct(other as doc_id, y_from as begin_word)))"
    )
    alone = made.where("xs is null").selectExpr(ends, "other as other_doc_id", "y_from as other_begin", "of as seed")
    return aligned.unionByName(alone, allowMissingColumns=True)


def _left_over(aligned: DataFrame) -> DataFrame:
    """The seeds of two of what ``_aligned`` leaves over."""
    ends = aligned.where("seed is not null and other_doc_id is not null")
    ends = ends.groupBy("seed", F.col("doc_id").alias("doc"), F.col("begin_word").alias("pos"))
    ends = stored(ends.agg(F.min(F.struct("other_doc_id", "other_begin")).alias("rep")), "left_over")
    # Of three documents two have not been compared with one another.
    holders = ends.select("seed", "doc").distinct().groupBy("seed").agg(F.count("*").alias("n"))
    # Written, so that the join can split a seed that very many have.
    contested = stored(holders.where("n > 2").select("seed", F.lit(True).alias("several")), "contested")
    ends = ends.join(contested, "seed", "left").selectExpr(
        "doc", "pos", "seed", "rep.other_doc_id as rep", "rep.other_begin as rep_pos",
        "coalesce(several, false) as contested",
    )
    ends = ends.repartition("doc").sortWithinPartitions("doc", "pos", "seed")
    return in_arrow(ends, _compounds, "seed long, doc long, pos int")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, begin_word, end_word, other_doc_id, other_begin, other_end, identity of each passage of
    at least ``MIN_WORDS`` words that a document shares with another one.

    Word spans are half open.  Every document that repeats a passage is returned with a document
    that holds it too (one with a smaller doc_id).  These links connect all documents that share a
    run of fifty words or more.  Of an edited passage without such a run a document can be missed where
    earlier ones hold parts of it, but only if they hold every two of its seeds that are near each other.
    Rows that share a doc_id are one document, of which the greatest text gives the words that are aligned; null ids take no part, null texts are empty, and a passage
    repeated within one document only is not returned.  A text is handled whole by one task, which
    takes some tens of bytes for each of its words; a pair of documents with more than 2^26 matches
    is chained in pieces.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text().alias("text"))
    rows = rows.where("doc_id is not null")
    first = _aligned(_matches(in_arrow(rows, _collect_seeds, _SEEDS)), rows)
    first = stored(first, "aligned")
    passages = first.where("seed is null").drop("seed")
    runs = first.where("seed is not null and other_doc_id is null")
    runs = runs.selectExpr("seed", "doc_id as doc", "begin_word as pos")
    second = _aligned(_matches(in_arrow(runs, _collect_runs, _SEEDS)), rows)
    third = _aligned(_matches(in_arrow(_left_over(first), _collect_runs, _SEEDS)), rows)
    for more in (second, third):
        passages = passages.union(more.where("seed is null").drop("seed"))
    # A passage of a later pass may be a longer or shorter form of one of the first.
    line = Window.partitionBy("doc_id", "other_doc_id", F.col("begin_word") - F.col("other_begin"))
    before = line.orderBy("begin_word", F.desc("end_word"), F.desc("other_end"), F.desc("identity"))
    reached = F.max("end_word").over(before.rowsBetween(Window.unboundedPreceding, -1))
    passages = passages.withColumn("reached", reached)
    return passages.where("reached is null or reached < end_word").drop("reached")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The repeated passages of all ``documents``."""
    return repeated_passages(table(spark, sf_dir, "documents"))
