"""Near-duplicate groups by SimHash, found through segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits.  The vector of
their bit counts embeds it in a grid where the Manhattan distance never
exceeds the Hamming distance, so near fingerprints are near in the grid.  If
two fingerprints differ in at most ``d`` bits, one of the two halves of the
vector (16 segments each) is within ``d // 2``; both ends then list a common
grid cell of that half when each lists all cells within half that radius.
Rows of one cell meet in one task, where the Hamming distance is verified.

Only a spanning forest of the links of a cell is kept, never all its pairs.  A
cell with more than ``CELL_ROWS`` different fingerprints is not held in one
task: its rows are passed on and cut again by the quarters of the other half.
What is overfull even then is cut in blocks, and every two blocks meet in a task
of their own, which holds about ``CELL_ROWS`` rows at once.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; repeated rows give repeated rows of one component; a null
doc_id is kept and has no part in the component's smallest id (a component of
null ids has a null component_id); an empty table gives no rows; further
columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import map_rows, table
from textmill.llm.graph import components
from textmill.session import written

CELL_ROWS = 20_000
SEED = 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Bits of each byte value, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_EVEN = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the word shingles of ``text`` as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle]))
        hashes = [digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), (ends[shingle - 1:] - 1).tolist())]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    # One histogram per byte place, then bits per byte value: cheaper than
    # unpacking 64 columns for every shingle.
    counts = np.bincount((octets + (np.arange(8) * 256)).ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BITS).ravel()
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document, whole texts, no shuffle."""
    def run(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "text_hash": b["text_hash"], "fp": [fingerprint(t, shingle) for t in b["text"]]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), run,
                    f"doc_id {kind}, text_hash bigint, fp bigint")


def bit_counts(fps: np.ndarray) -> np.ndarray:
    """The 32 segment counts of each fingerprint, packed two bits apiece."""
    return (fps & _EVEN) + ((fps >> np.uint64(1)) & _EVEN)


def _around(cells: np.ndarray, places: range, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All grid points within ``radius`` of each cell in the 2-bit fields
    ``places``: (row, point) without repeats."""
    rows, points = np.arange(len(cells)), cells
    for _ in range(radius):
        more_r, more_p = [rows], [points]
        for i in places:
            one, field = np.uint64(1 << 2 * i), (points >> np.uint64(2 * i)) & np.uint64(3)
            for ok, moved in ((field < 2, points + one), (field > 0, points - one)):
                more_r.append(rows[ok])
                more_p.append(moved[ok])
        rows, points = np.concatenate(more_r), np.concatenate(more_p)
        if radius > 1:
            pairs = np.unique(np.rec.fromarrays([rows, points]))
            rows, points = pairs.f0, pairs.f1
    return rows, points


def _mask(places: range) -> np.uint64:
    return np.uint64(sum(3 << 2 * i for i in places))


def _tag(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit cell key; a collision of two cells only adds candidates."""
    x = (points + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _cells(fps: DataFrame, d: int) -> DataFrame:
    """(cell, fp) for both halves; ``side`` tells the half the cell is of."""
    radius = (d // 2 + 1) // 2

    def run(batches):
        for b in batches:
            all_fps = np.array(b["fp"], np.int64).view(np.uint64)
            for lo in range(0, len(all_fps), 20_000):
                f = all_fps[lo:lo + 20_000]
                for side, places in enumerate((range(16), range(16, 32))):
                    rows, points = _around(bit_counts(f) & _mask(places), places, radius)
                    yield {"side": np.full(len(rows), side, np.int32), "cell": _tag(points, side).view(np.int64),
                           "fp": f[rows].view(np.int64)}

    return map_rows(fps, run, "side int, cell bigint, fp bigint")


def _cells_again(rest: DataFrame, d: int) -> DataFrame:
    """Rows of overfull cells, dealt again by the quarters of the other half."""
    radius = (d // 2 + 1) // 2

    def run(batches):
        for b in batches:
            side, cell = np.array(b["side"], np.int32), np.array(b["cell"], np.int64).view(np.uint64)
            f = np.array(b["fp"], np.int64).view(np.uint64)
            for s in (0, 1):
                of, c = f[side == s], cell[side == s]
                for lo in range(0, len(of), 20_000):
                    g, gc = of[lo:lo + 20_000], c[lo:lo + 20_000]
                    first = 16 * (1 - s)
                    for places in (range(first, first + 8), range(first + 8, first + 16)):
                        rows, points = _around(bit_counts(g) & _mask(places), places, radius)
                        key = _tag(points ^ gc[rows], 2 + places[0])
                        yield {"side": np.full(len(rows), s, np.int32), "cell": key.view(np.int64),
                               "fp": g[rows].view(np.int64)}

    return map_rows(rest, run, "side int, cell bigint, fp bigint")


def _forest(f: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among the different fingerprints ``f``:
    every node is held against those not reached yet, once."""
    left, a, b = f, [], []
    while len(left):
        queue, left = [left[:1]], left[1:]
        while queue and len(left):
            for x in queue.pop():
                near = np.bitwise_count(left ^ x) <= d
                if near.any():
                    reached, left = left[near], left[~near]
                    a.append(np.full(len(reached), x))
                    b.append(reached)
                    queue.append(reached)
    none = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _links(cells: DataFrame, d: int, limit: int | None) -> DataFrame:
    """Verified links (a, b) of each cell; rows of cells beyond ``limit`` come
    back as they were, with ``cell`` set."""
    small = 48

    def pairs(cell, f):
        """All links of the short runs of equal ``cell`` at once, forests of the long."""
        cut = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
        size = np.diff(cut)
        found_a, found_b = [], []
        for i in np.flatnonzero(size > small):
            a, b = _forest(np.unique(f[cut[i]:cut[i + 1]]), d)
            found_a.append(a)
            found_b.append(b)
        short = np.repeat(size <= small, size)
        c, g = cell[short], f[short]
        for shift in range(1, min(small, len(c))):
            same = np.flatnonzero(c[shift:] == c[:-shift])
            if not len(same):
                break
            x, y = g[same], g[same + shift]
            near = (np.bitwise_count(x ^ y) <= d) & (x != y)
            found_a.append(x[near])
            found_b.append(y[near])
        if not found_a:
            return None
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        if not len(a):
            return None
        e = np.unique(np.rec.fromarrays([np.minimum(a, b), np.maximum(a, b)]))
        return {"a": e.f0.view(np.int64), "b": e.f1.view(np.int64), "side": [None] * len(e), "cell": [None] * len(e)}

    def passed(side, cell, f):
        none = [None] * len(f)
        return {"a": f.view(np.int64), "b": none, "side": side, "cell": cell}

    def run(batches):
        side, cell, f = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)
        over = None  # the cell whose rows are being passed on
        for b in batches:
            side = np.concatenate((side, np.array(b["side"], np.int32)))
            cell = np.concatenate((cell, np.array(b["cell"], np.int64)))
            f = np.concatenate((f, np.array(b["fp"], np.int64).view(np.uint64)))
            if over is not None and len(cell):
                n = int(np.searchsorted(cell != over, True))
                if n:
                    yield passed(side[:n], cell[:n], f[:n])
                    side, cell, f = side[n:], cell[n:], f[n:]
                if len(cell):
                    over = None
            if not len(cell):
                continue
            last = int(np.searchsorted(cell, cell[-1]))  # rows of this cell may go on in the next batch
            if last:
                yield from (x for x in [pairs(cell[:last], f[:last])] if x)
                side, cell, f = side[last:], cell[last:], f[last:]
            if limit and len(cell) > limit:
                yield passed(side, cell, f)
                over, side, cell, f = cell[-1], side[:0], cell[:0], f[:0]
        if len(cell):
            yield from (x for x in [pairs(cell, f)] if x)

    return map_rows(cells.repartition("cell").sortWithinPartitions("cell"), run,
                    "a bigint, b bigint, side int, cell bigint")


def links(fps: DataFrame, max_bits: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) that connect all different fingerprints of ``fps`` (fp) at
    ``max_bits`` or fewer differing bits."""
    found = written(_links(_cells(fps, max_bits), max_bits, cell_rows), "links")
    rest = found.filter("cell is not null").select("side", "cell", F.col("a").alias("fp"))
    edges = found.filter("cell is null").select("a", "b")
    if rest.limit(1).count():
        again = written(_links(_cells_again(rest, max_bits), max_bits, cell_rows), "links")
        edges = edges.unionByName(again.filter("cell is null").select("a", "b"))
        dense = again.filter("cell is not null").select("side", "cell", F.col("a").alias("fp"))
        if dense.limit(1).count():
            edges = edges.unionByName(_links(_blocks(dense, cell_rows), max_bits, None).select("a", "b"))
    return edges


def _blocks(dense: DataFrame, cell_rows: int) -> DataFrame:
    """Rows of cells that stay overfull, dealt so that any two rows of a cell meet:
    blocks of half the limit, a new cell for every two of them."""
    sizes = dense.groupBy("side", "cell").agg(F.ceil(2 * F.count("*") / cell_rows).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pair = F.xxhash64("side", "cell", F.least("own", "other"), F.greatest("own", "other"))
    return (dense.join(sizes, ["side", "cell"]).select("side", "cell", "fp", own.alias("own"), other)
            .select("side", pair.alias("cell"), "fp"))


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) for every row of ``docs`` (doc_id,
    text); ``text_hash`` is Spark's 64-bit hash of the text and tells rows of one
    id apart.

    Copies share one fingerprint, which enters the search once, however many
    documents have it."""
    if not 0 <= max_bits <= 9:
        raise ValueError("max_bits must be between 0 and 9")
    fps = written(fingerprints(docs, shingle), "fingerprints")
    # Combined before the shuffle: a copied text costs one row per task.
    different = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "different")
    roots = written(components(links(different.select("fp"), max_bits)), "roots")
    member = different.join(roots, different.fp == roots.node)
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    of_linked = member.join(ids, "root").select("fp", "component_id")
    # Written, so that the last join reads two plain tables and a fingerprint
    # that very many documents share is split at run time.
    by_fp = written(different.join(of_linked, "fp", "left")
                    .select("fp", F.coalesce("component_id", "least").alias("component_id")), "components")
    return fps.join(by_fp, "fp").select("doc_id", "text_hash", "fp", "component_id")


def op10_simhash_near_dedup(spark, sf_dir):
    """All documents with their fingerprint and component."""
    out = simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
