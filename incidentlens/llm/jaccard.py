"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of 5-word shingles; two link when 100 * |x & y| >= 75 * |x | y|. All shingles
have one global order, rare first (frequencies from a sketch over all documents). A pair that
links shares at least ``l`` of the first ``|x| - ceil(0.75 |x|) + l`` shingles of either side,
for every l; so each document picks the l that its estimated candidates ask for, and a pair is
verified only when it shares min(l, l') prefix shingles. Verification is exact.

Copies (equal sets) are one node from the start. Candidates come in rounds: every set against the
hub of another component with which it shares most prefix shingles, until a round finds few links.
So a group of n near copies costs about n checks a round. What is left in different components is finished
in two ways. Shingles of at most ``SMALL`` sets give their pairs, a bounded number for each set; these are counted, and those
with enough shared prefix shingles verified. Sets of any other shingle are checked where they meet: the rarest shingle that a
linking pair shares lies in the first ``|x| - ceil(0.75 |x|) + 1`` of both, so such sets are compared there, after
size and place in the order have ruled out most, and only links leave that place, at most one for each set. So rows
grow with the sets, not with their pairs, and no link is lost for the components.

Every set has a parity: its shingles counted in cells, one bit a cell. Sets that differ in d shingles have parities that differ in
at most d bits, so the parity, a small part of a text's size, rules out most pairs that do not link before any text is shuffled. Sets
that meet over a large shingle are first linked to one set each, on texts; only those left in different components go to their places.

Defined results: a NULL, empty or white-space text has no shingles and is a component of its
own; rows that repeat a doc_id are one document; a NULL doc_id links with nothing; an empty table gives an empty result; input
columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, Words, discard, scramble, shingles, slices, stored, table, without
from . import copies
from .graph import components

N_GRAM = 5
PERCENT = 75
#: Cells of the frequency sketch: one count per cell reaches the driver and every task.
SKETCH = 1 << 17
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64])
#: Assumed chance partners of a prefix shingle, and the cost of a candidate in shuffled shingles.
CHANCE, CANDIDATE_COST = 0.05, 3.0
#: Members of one hub that are verified in one place; beyond that the hub's set is copied.
PER_HUB = 2000
#: Sets of one shingle, and shingles of these sets, that are compared with as many others in one place.
PER_BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
#: Sets of a shingle whose pairs are counted one by one: at most (SMALL - 1) / 2 rows for each set.
SMALL = 32
#: Rounds end when one brings less than this share of the first one's links; the rest is found pair by pair.
FEW = 0.1


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 17)).astype(np.int64)


def frequency_sketch(docs: DataFrame) -> np.ndarray:
    """Shingle counts by hash cell over all documents."""
    def run(batches):
        total = np.zeros(SKETCH, np.int64)
        for batch in slices(batches):
            h, _ = shingles(Words(batch.column(0)), N_GRAM)
            total += np.bincount(_cells(h), minlength=SKETCH)
        cell = np.flatnonzero(total)
        for at in range(0, len(cell), 1 << 16):
            part = cell[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part])], names=["cell", "n"])

    out = np.zeros(SKETCH, np.int64)
    rows = docs.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for r in rows.collect():
        out[r["cell"]] = r["n"]
    return out


def prefix(h: np.ndarray, weight: np.ndarray, usual: float) -> tuple[np.ndarray, int]:
    """Prefix shingles and level of one set (sorted distinct hashes)."""
    n = len(h)
    order = np.lexsort((h, weight))
    need = -(-PERCENT * n // 100)  # overlap with any partner is at least this
    levels = LEVELS[LEVELS <= need]
    length = n - need + levels
    excess = np.cumsum(np.maximum(weight[order] - usual, 0.0) + CHANCE)[length - 1]
    k = int(np.argmin(length + CANDIDATE_COST * excess / levels ** 2))
    return h[order[: length[k]]], int(levels[k])


def digest(h: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def parity(h: np.ndarray) -> bytes:
    """Whether each cell holds an odd number of the distinct hashes ``h``, one bit a cell, two to four cells for each hash.

    A hash that only one of two sets has flips one bit: parities differ in no more bits than their sets in hashes."""
    cells = max(64, 1 << (2 * len(h) - 1).bit_length())
    return np.packbits((np.bincount((h & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1).astype(np.uint8)).tobytes()


def _folded(p: bytes, size: int) -> bytes:
    """The parity ``p`` over fewer cells (``size`` bytes)."""
    while len(p) > size:
        half = len(p) // 2
        p = (int.from_bytes(p[:half]) ^ int.from_bytes(p[half:])).to_bytes(half)
    return p


def parity_gap(p: bytes, q: bytes) -> int:
    """Bits in which two parities differ."""
    size = min(len(p), len(q))
    return (int.from_bytes(_folded(p, size)) ^ int.from_bytes(_folded(q, size))).bit_count()


def signatures(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(doc_id, key, n_shingles, hi, lo, level, prefix, parity) per row; key: hash of the text, hi, lo: digest of the set (NULL if empty).

    The prefix, rarest shingle first, and the parity are given once per set and batch."""
    shared = Shared(docs.sparkSession, sketch)

    def run(batches):
        cells = shared.get()
        usual = float(np.median(cells)) * 1.2 + 4.0
        for batch in slices(batches):
            h, starts = shingles(Words(batch.column(1)), N_GRAM)
            rows, known = [], set()
            for i in range(batch.num_rows):
                own = np.unique(h[starts[i]:starts[i + 1]])
                if not len(own):
                    rows.append((0, None, None, 0, None, None))
                    continue
                hi, lo = digest(own)
                if (hi, lo) in known:
                    rows.append((len(own), hi, lo, 0, None, None))
                    continue
                known.add((hi, lo))
                tokens, level = prefix(own, cells[_cells(own)], usual)
                rows.append((len(own), hi, lo, level, tokens.view(np.int64), parity(own)))
            n, his, los, levels, prefixes, parities = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(his, pa.int64()), pa.array(los, pa.int64()),
                 pa.array(levels, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(parities, pa.binary())],
                names=["doc_id", "key", "n_shingles", "hi", "lo", "level", "prefix", "parity"])

    return docs.select("doc_id", "text", text_key().alias("key")).mapInArrow(
        run, "doc_id long, key long, n_shingles long, hi long, lo long, level int, prefix array<long>, parity binary")


def text_key():
    """Tells the texts of one doc_id apart (NULL and empty alike)."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _groups(batches, column: str, limit: int = 1 << 20):
    """Sorted batches as columns of whole groups; a group larger than ``limit`` rows comes in parts,
    the last value of ``part`` telling whether the group goes on."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        key = t.column(column).to_numpy()
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))  # the last group may go on in the next batch
        if cut:
            yield {c: t.column(c).to_numpy()[:cut] for c in t.column_names}, False
        held = t.slice(cut)
        if held.num_rows > limit:
            yield {c: held.column(c).to_numpy() for c in held.column_names}, True
            held = held.slice(0, 0)
    if held is not None and held.num_rows:
        yield {c: held.column(c).to_numpy() for c in held.column_names}, False


HUBS = 16
MAX_ROUNDS = 3


def shared_postings(sigs: DataFrame) -> DataFrame:
    """(token, lo, n, pos) of every prefix shingle that several sets have, once per set; n: the set's size, pos: the
    shingle's place in its order."""
    def run(batches):
        last = None  # token and last set of a group that came in parts
        for cols, more in _groups(batches, "token"):
            token, lo = cols["token"], cols["lo"]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (lo[1:] != lo[:-1])
            goes_on = last is not None and token[0] == last[0]
            new[0] = not (goes_on and lo[0] == last[1])
            if not new.any():
                continue
            token, lo, n, pos = (cols[c][new] for c in ("token", "lo", "n", "pos"))
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            size = np.diff(np.concatenate([start, [len(token)]]))
            keep = size > 1
            keep[0] |= goes_on
            keep[-1] |= more
            keep = np.repeat(keep, size)
            last = (token[-1], lo[-1]) if more else None
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (token, lo, n, pos)], names=["token", "lo", "n", "pos"])

    rows = sigs.where("prefix is not null").select("lo", F.col("n_shingles").cast("int").alias("n"),
                                                   F.posexplode("prefix").alias("pos", "token"))
    rows = rows.repartition("token").sortWithinPartitions("token", "lo").select("token", "lo", "n", "pos")
    return rows.mapInArrow(run, "token long, lo long, n int, pos int")


def live_postings(postings: DataFrame, parts: DataFrame | None, round_: int) -> DataFrame:
    """``postings`` (token, lo, ...) with (component, hub, hub_component), of the shingles whose sets lie in several components;
    with places, also the hub's (hub_n, hub_pos).

    The hub is the first set by one of HUBS orders, picked by shingle and round; in a group larger
    than one part, the first of each part and those before it."""
    masks = scramble(np.arange(1, HUBS + 1, dtype=np.uint64) + np.uint64(1000 * (round_ + 1))).view(np.int64)
    own = [f for f in postings.schema.fields if f.name in ("token", "lo", "n", "pos")]
    of_hub = ["lo", "component", *[f.name for f in own if f.name in ("n", "pos")]]
    names = [*[f.name for f in own], "component", "hub", *[f"hub_{c}" for c in of_hub[1:]]]
    types = {f.name: f.dataType.simpleString() for f in own} | {"component": "long", "hub": "long", "hub_component": "long",
                                                               "hub_n": "int", "hub_pos": "int"}

    def run(batches):
        before = None  # token and hub of a group that came in parts
        for cols, more in _groups(batches, "token"):
            token, lo, comp = cols["token"], cols["lo"], cols["component"]
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            size = np.diff(np.concatenate([start, [len(token)]]))
            lowest, highest = np.minimum.reduceat(comp, start), np.maximum.reduceat(comp, start)
            rank = lo ^ masks[token & (HUBS - 1)]
            order = np.lexsort((rank, np.repeat(np.arange(len(start)), size)))
            hub = [cols[c][order[start]] for c in of_hub]
            keep = lowest != highest
            if before is not None and token[0] == before[0]:
                for h, value in zip(hub, before[1]):
                    h[0] = value
                keep[0] = True
            if more:
                keep[-1] = True
            before = (token[-1], [h[-1] for h in hub]) if more else None
            keep = np.repeat(keep, size)
            out = [cols[f.name] for f in own] + [comp] + [np.repeat(h, size) for h in hub]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in out], names=names)

    rows = postings.select(*[f.name for f in own])
    if parts is None:
        rows = rows.withColumn("component", F.col("lo"))
    else:
        rows = rows.join(parts, "lo", "left").withColumn("component", F.coalesce("component", "lo"))
    rows = rows.repartition("token").sortWithinPartitions("token", "lo").select(*[f.name for f in own], "component")
    return rows.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in names))


def deal_blocks(live: DataFrame, per_block: int) -> DataFrame:
    """Rows of ``live`` (token, lo, component, ...) once per cell (token, i, j) they belong to, with their block.

    A token of up to ``per_block`` rows (and, with sizes ``n``, BLOCK_SHINGLES shingles) is one block. Those of a larger one are
    dealt over blocks, the rows of its largest component over blocks of their own; every two blocks that can hold a pair of
    different components are one cell, so each such pair meets in exactly one, of bounded size."""
    weigh = "n" in live.columns
    more = [c for c in ("n", "pos") if c in live.columns]
    shingles_ = F.sum("n") if weigh else F.lit(0)
    size = live.groupBy("token").agg(F.count("*").alias("k_all"), shingles_.alias("w_all"))
    size = size.where((F.col("k_all") > per_block) | (F.col("w_all") > BLOCK_SHINGLES)).select("token")
    size = live.join(size, "token").groupBy("token", "component").agg(F.count("*").alias("k"), shingles_.alias("w"))
    size = size.groupBy("token").agg(F.sum("k").alias("k_all"), F.sum("w").alias("w_all"), F.max(F.struct("k", "w", "component")).alias("top"))

    def blocks(k, w):
        return (F.floor(F.greatest(k / per_block, w / BLOCK_SHINGLES)) + 1).cast("int")

    size = size.select("token", F.col("top.component").alias("top"), blocks(F.col("k_all") - F.col("top.k"), F.col("w_all") - F.col("top.w")).alias("others"),
                       blocks(F.col("top.k"), F.col("top.w")).alias("tops"))
    dealt = live.select("token", "lo", "component", *more).join(size, "token", "left")
    salt, others = F.pmod(F.xxhash64("lo", "token"), F.lit(1 << 30)), F.coalesce("others", F.lit(1))
    own = F.coalesce(F.col("component") == F.col("top"), F.lit(False))
    dealt = dealt.withColumn("block", F.when(own, others + salt % F.col("tops")).otherwise(salt % others).cast("int"))
    last = F.when(own, others).otherwise(others + F.coalesce("tops", F.lit(0))) - 1
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return dealt.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "lo", "component", *more)


def _needed(n, m):
    """Fewest shared shingles of two sets that link: 100 * both >= 75 * (n + m - both)."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def _cells_of(batches, key: int = 3):
    """The rows of each cell of sorted batches, as columns; the first ``key`` columns name the cell."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(key)])
        cut = np.flatnonzero(np.concatenate([[True], np.any(place[:, 1:] != place[:, :-1], axis=0)]))
        for at, end in zip(cut, [*cut[1:], batch.num_rows]):
            name = tuple(place[:, at])
            if name != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = name
            held.append(batch.slice(at, end - at))
    if held:
        yield pa.Table.from_batches(held)


def pairs_of_small(live: DataFrame) -> DataFrame:
    """(x, y, x_n, y_n, x_pos, y_pos) of every two sets of a shingle that lie in different components and fit in size; no
    shingle of ``live`` has more than SMALL sets."""
    def run(batches):
        for cols, _ in _groups(batches, "token", limit=1 << 40):
            token, lo, comp = (cols[c] for c in ("token", "lo", "component"))
            n, pos = cols["n"].astype(np.int64), cols["pos"]
            place = np.arange(len(token))
            for step in range(1, SMALL):  # pairs that lie ``step`` apart, sorted by shingle and set
                place = place[place + step < len(token)]
                place = place[token[place] == token[place + step]]
                if not len(place):
                    break
                a, b = place, place + step
                ok = (comp[a] != comp[b]) & (100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b]))
                a, b = a[ok], b[ok]
                for at in range(0, len(a), 1 << 17):
                    x, y = a[at:at + (1 << 17)], b[at:at + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (lo[x], lo[y], n[x].astype(np.int32), n[y].astype(np.int32), pos[x], pos[y])],
                                                     names=["x", "y", "x_n", "y_n", "x_pos", "y_pos"])

    rows = live.repartition("token").sortWithinPartitions("token", "lo").select("token", "lo", "component", "n", "pos")
    return rows.mapInArrow(run, "x long, y long, x_n int, y_n int, x_pos int, y_pos int")


def rest_of_small(live: DataFrame, large: DataFrame, classes: DataFrame) -> DataFrame:
    """(x, hub) of the pairs to verify whose rarest shared shingle is not ``large`` (token).

    Pairs are counted over the small shingles; those of the large ones count as shared, as far as both sets have any."""
    counted = (pairs_of_small(live.join(large, "token", "left_anti")).groupBy("x", "y")
               .agg(F.count("*").alias("k"), F.first("x_n").alias("x_n"), F.first("y_n").alias("y_n"), F.min("x_pos").alias("x_pos"),
                    F.min("y_pos").alias("y_pos")))
    in_large = live.join(large, "token", "left_semi").groupBy("lo").agg(F.count("*").alias("more"))
    side = classes.select("lo", "level").join(in_large, "lo", "left").select("lo", "level", F.coalesce("more", F.lit(0)).alias("more"))
    of = lambda p: side.select(F.col("lo").alias(p), F.col("level").alias(f"{p}_level"), F.col("more").alias(f"{p}_more"))
    near = counted.where(_can_link()).join(of("x"), "x").join(of("y"), "y")
    near = near.where(F.col("k") + F.least("x_more", "y_more") >= F.least("x_level", "y_level"))
    return near.select("x", F.col("y").alias("hub"))


def first_meetings(live: DataFrame, large: DataFrame) -> DataFrame:
    """Rows of ``live`` in first prefixes and of ``large`` shingles, without shingles all whose sets have met before.

    If the sets of a shingle all have one and the same shingle as their last one before it, they all meet there."""
    rows = live.where(f"pos <= n - ceil({PERCENT} * n / 100)").join(large, "token", "left_semi")
    last = F.lag("token").over(Window.partitionBy("lo").orderBy("pos"))
    again = (rows.withColumn("_last", last).groupBy("token").agg(F.min("_last").alias("a"), F.max("_last").alias("z"),
                                                                 F.count("_last").alias("k"), F.count("*").alias("all"))
             .where("a = z and k = all").select("token"))
    return rows.join(again, "token", "left_anti")


CELL = "token long, i int, j int, block int, lo long, component long, n int, pos int"


def _gaps(parities: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which the parities of ``a`` and of ``b`` differ; 0 where one is more than twice as long (the sizes rule those out)."""
    size = np.array([len(p) for p in parities])
    out = np.zeros((len(a), len(b)), np.float32)

    def bits(rows, to):
        return np.unpackbits(np.frombuffer(b"".join(_folded(parities[r], to) for r in rows), np.uint8).reshape(len(rows), to), axis=1).astype(np.float32)

    for s in np.unique(size[a]):
        for t in np.unique(size[b]):
            if max(s, t) <= 2 * min(s, t):
                p, q = np.flatnonzero(size[a] == s), np.flatnonzero(size[b] == t)
                x, y = bits(a[p], int(min(s, t))), bits(b[q], int(min(s, t)))
                out[np.ix_(p, q)] = x.sum(axis=1)[:, None] + y.sum(axis=1) - 2 * (x @ y.T)
    return out


def _fitting(cell: pa.Table):
    """(a, b, ok): some rows of a cell's one block, all of the other, and whether each pair is of different components and not
    ruled out by sizes, places and, if given, parities."""
    i, j, block, comp, n, pos = (cell.column(c).to_numpy() for c in ("i", "j", "block", "component", "n", "pos"))
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    parities = cell.column("parity").to_pylist() if "parity" in cell.column_names else None
    a, b = np.flatnonzero(block == i[0]), np.flatnonzero(block == j[0])
    if len(a) * len(b) < 2:
        return
    for at in range(0, len(a), 256):
        x = a[at:at + 256, None]
        needed = _needed(n[x], n[b])
        ok = (np.minimum(n[x] - pos[x], n[b] - pos[b]) >= needed) & (comp[x] != comp[b])
        if parities is not None and ok.any():
            ok &= _gaps(parities, x[:, 0], b) <= n[x] + n[b] - 2 * needed
        yield x[:, 0], b, ok


def _with_partner(batches):
    """The rows of cells that have a fitting partner."""
    for cell in _cells_of(batches):
        keep = np.zeros(cell.num_rows, bool)
        for a, b, ok in _fitting(cell):
            keep[a] |= ok.any(axis=1)
            keep[b] |= ok.any(axis=0)
        if keep.any():
            names = [c.split()[0] for c in CELL.split(", ")]
            yield from cell.select(names).take(pa.array(np.flatnonzero(keep))).combine_chunks().to_batches()


def _by_cell(rows: DataFrame, *more: str) -> DataFrame:
    rows = rows.select(*[c.split()[0] for c in CELL.split(", ")], *more)
    return rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")


def worth_checking(live: DataFrame) -> DataFrame:
    """(token, i, j, block, lo, component, n, pos) of the sets that have a partner in their cell: of another component, and not
    ruled out by sizes and places.

    ``live`` holds first prefixes only, so a linking pair meets in the cell of the rarest shingle it shares, where nothing
    before the shingle's place is shared."""
    return _by_cell(deal_blocks(live, PER_BLOCK)).mapInArrow(_with_partner, CELL)


def _parities(classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(lo, n_shingles, parity) of the sets among ``ids`` (lo), and of few others."""
    return _among(classes.select("lo", "n_shingles", "parity"), ids, "lo")


def left_in_cells(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``cells`` that have a partner of another component, parities considered too."""
    return _by_cell(cells.join(_parities(classes, cells).select("lo", "parity"), "lo"), "parity").mapInArrow(_with_partner, CELL)


def cell_hubs(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """(x, hub): each set of ``cells`` with the smallest one before it that it meets and may link to, so one row for each set."""
    def run(batches):
        for cell in _cells_of(batches):
            lo = cell.column("lo").to_numpy()
            hub = lo.copy()
            for a, b, ok in _fitting(cell):
                x, y = lo[a][:, None], lo[b][None, :]
                hub[a] = np.minimum(hub[a], np.where(ok, y, x).min(axis=1))
                hub[b] = np.minimum(hub[b], np.where(ok, x, y).min(axis=0))
            x = np.flatnonzero(hub < lo)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(lo[x]), pa.array(hub[x])], names=["x", "hub"])

    rows = _by_cell(cells.join(_parities(classes, cells).select("lo", "parity"), "lo"), "parity")
    return rows.mapInArrow(run, "x long, hub long").groupBy("x").agg(F.min("hub").alias("hub"))


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The ``pairs`` (x, hub) that sizes and parities do not rule out."""
    def run(batches):
        for batch in batches:
            n, m, p, q = (batch.column(k).to_pylist() for k in range(2, 6))
            keep = [parity_gap(p[k], q[k]) <= n[k] + m[k] - 2 * _needed(n[k], m[k]) for k in range(len(n))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    ids = pairs.select(F.explode(F.array("x", "hub")).alias("lo"))
    known = _parities(classes, ids)
    of = lambda c: known.select(F.col("lo").alias(c), F.col("n_shingles").alias(f"{c}_n"), F.col("parity").alias(f"{c}_parity"))
    rows = pairs.join(of("x"), "x").join(of("hub"), "hub").select("x", "hub", "x_n", "hub_n", "x_parity", "hub_parity")
    return rows.mapInArrow(run, "x long, hub long")


def links_in_cells(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) that join the sets of each cell as its links do; ``sets`` (lo, items) has every set of ``cells``.

    A link between sets that links of the cell already join is left out, so a cell gives fewer rows than it has sets."""
    def check(batches):
        for cell in _cells_of(batches):
            i, j, block, lo, comp = (cell.column(c).to_numpy() for c in ("i", "j", "block", "lo", "component"))
            items = [np.frombuffer(x, np.uint64) for x in cell.column("items").to_pylist()]
            a, b = np.flatnonzero(block == i[0]), np.flatnonzero(block == j[0])
            x, y = linked_pairs(items, a, b, comp)
            if len(x):
                keep = _forest(comp[x], comp[y])
                yield pa.RecordBatch.from_arrays([pa.array(lo[x[keep]]), pa.array(lo[y[keep]])], names=["a", "b"])

    rows = cells.join(sets, "lo").select("token", "i", "j", "block", "lo", "component", "items")
    rows = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return rows.mapInArrow(check, "a long, b long")


def linked_pairs(sets: list, a: np.ndarray, b: np.ndarray, comp: np.ndarray, width: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a set of ``a`` and one of ``b``, of different components, that link."""
    n = np.array([len(x) for x in sets])
    if len(a) * len(b) <= 16:
        found = [(x, y) for x in a for y in b if x != y and comp[x] != comp[y] and min(n[x], n[y]) >= _needed(n[x], n[y])
                 and len(np.intersect1d(sets[x], sets[y], assume_unique=True)) >= _needed(n[x], n[y])]
        return tuple(np.array([f[k] for f in found], np.int64) for k in range(2))
    row = np.repeat(np.arange(len(sets)), n)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, code = row[times[code] > 1], code[times[code] > 1]
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    at_a, at_b = np.full(len(sets), -1), np.full(len(sets), -1)
    at_a[a], at_b[b] = np.arange(len(a)), np.arange(len(b))
    both = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        lo, hi = np.searchsorted(code, [at, at + width])
        sides = []
        for place, size in ((at_a, len(a)), (at_b, len(b))):
            has = np.zeros((size, width), np.float32)
            r = place[row[lo:hi]]
            has[r[r >= 0], code[lo:hi][r >= 0] - at] = 1
            sides.append(has)
        both += sides[0] @ sides[1].T
    ok = (both >= _needed(n[a][:, None], n[b][None, :])) & (comp[a][:, None] != comp[b][None, :])
    x, y = np.nonzero(ok)
    return a[x], b[y]


def _forest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of edges (x, y) that join what the edges before them do not."""
    up: dict[int, int] = {}

    def find(v):
        while (w := up.get(v, v)) != v:
            up[v] = up.get(w, w)
            v = w
        return v

    keep = []
    for k, (p, q) in enumerate(zip(x.tolist(), y.tolist())):
        p, q = find(p), find(q)
        if p != q:
            up[p] = q
            keep.append(k)
    return np.array(keep, np.int64)


def _among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` may be among that of ``ids``: a filter of bounded size rules out most others, before any is shuffled."""
    bits = copies.MIN_BITS * 8
    return copies.with_verdict(rows, key, bits, copies.key_filter(ids, key, bits)).where("_maybe").drop("_maybe")


def _of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id may be among ``ids`` (doc)."""
    return _among(docs.withColumnRenamed("doc_id", "doc"), ids, "doc")


def set_items(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lo, items) of the sets ``wanted`` (lo, doc): the sorted shingle hashes of the document's text with that set."""
    # joined by shuffle at every size: the ids of the wanted sets have no bound
    texts = _of_ids(docs.select("doc_id", "text"), wanted).join(wanted.hint("merge"), "doc").select("lo", "text")

    def run(batches):
        for batch in slices(batches):
            h, starts = shingles(Words(batch.column(1)), N_GRAM)
            out = []
            for i, lo in enumerate(batch.column(0).to_pylist()):
                own = np.unique(h[starts[i]:starts[i + 1]])
                if len(own) and digest(own)[1] == lo:  # else another row of this doc_id
                    out.append((lo, own.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())],
                                             names=["lo", "items"])

    return texts.mapInArrow(run, "lo long, items binary")


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of the ``pairs`` (x, hub) of sets that link, checked on the texts.

    Texts go to their hub; a hub with many members is checked in several places, each with its own copy of the hub's set."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("x"), F.lit(1 << 30)))
    size = pairs.groupBy("hub").agg(F.count("*").alias("members"))
    size = size.withColumn("parts", (F.floor(F.col("members") / PER_HUB) + 1).cast("int"))
    member = (pairs.join(size.select("hub", "parts"), "hub")
              .select(F.col("x").alias("lo"), "hub", (F.col("salt") % F.col("parts")).cast("int").alias("part"), F.lit(1).alias("is_member")))
    hub = (size.select(F.col("hub").alias("lo"), "hub", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
           .withColumn("is_member", F.lit(0)))
    jobs = stored(member.unionByName(hub).join(classes.select("lo", "doc"), "lo"), "jaccard-jobs")
    # texts are dealt, not their sets, which are twice as large and do not compress; joined by shuffle at every size
    texts = _of_ids(docs.select("doc_id", "text"), jobs.select("doc").distinct())
    # equal rows of a doc_id give one set twice: a member then links twice, which changes nothing
    placed = texts.join(jobs.hint("merge"), "doc").select("hub", "part", "is_member", "lo", "text")

    def check(batches):
        now, center = None, None
        for batch in slices(batches):
            out = []
            cols = [batch.column(k).to_pylist() for k in range(4)]
            h, starts = shingles(Words(batch.column(4)), N_GRAM)
            for i, (hub_, part, is_member, lo) in enumerate(zip(*cols)):
                if is_member and (hub_, part) != now:
                    raise ValueError("a hub's set is missing")
                own = np.unique(h[starts[i]:starts[i + 1]])
                if not len(own) or digest(own)[1] != lo:  # another row of this doc_id
                    continue
                if not is_member:
                    now, center = (hub_, part), own
                    continue
                both = len(np.intersect1d(center, own, assume_unique=True))
                if 100 * both >= PERCENT * (len(center) + len(own) - both):
                    out.append((lo, hub_))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                              pa.array([o[1] for o in out], pa.int64())], names=["a", "b"])

    placed = placed.repartition("hub", "part").sortWithinPartitions("hub", "part", "is_member")
    links = stored(placed.mapInArrow(check, "a long, b long"), "jaccard-links")
    discard(jobs)
    return links


def _can_link():
    """Whether sizes (x_n, y_n) and the places of the first shared shingle (x_pos, y_pos) leave room for a link."""
    bound = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    return ((F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * PERCENT)
            & (bound * (100 + PERCENT) >= (F.col("x_n") + F.col("y_n")) * PERCENT))


def hub_pairs(live: DataFrame, classes: DataFrame) -> DataFrame:
    """(x, hub): every set with the hub of another component that it shares most prefix shingles with, if they are
    enough for both levels and sizes and places do not rule the pair out."""
    counted = (live.where("component <> hub_component").groupBy(F.col("lo").alias("x"), F.col("hub").alias("y"))
               .agg(F.count("*").alias("k"), F.first("n").alias("x_n"), F.first("hub_n").alias("y_n"), F.min("pos").alias("x_pos"),
                    F.min("hub_pos").alias("y_pos")))
    counted = counted.where(_can_link())
    level = lambda p: classes.select(F.col("lo").alias(p), F.col("level").alias(f"{p}_level"))
    near = counted.join(level("x"), "x").join(level("y"), "y").where(F.col("k") >= F.least("x_level", "y_level"))
    return near.groupBy("x").agg(F.min(F.struct((-F.col("k")).alias("minus"), F.col("y").alias("hub"))).alias("best")).select("x", "best.hub")


def set_components(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, sets (hi, lo, doc, ...) and (lo, component) of the sets that link to others."""
    sets = stored(signatures(docs, frequency_sketch(docs)), "jaccard-sets")
    live = stored(shared_postings(sets.where("doc_id is not null")), "jaccard-postings")
    classes = stored(sets.where("lo is not null and doc_id is not null").groupBy("hi", "lo")
                     .agg(F.min("doc_id").alias("doc"), F.max("n_shingles").alias("n_shingles"), F.max("level").alias("level"),
                          F.max("parity").alias("parity")), "jaccard-classes")
    sigs = stored(sets.drop("prefix", "parity"), "jaccard-rows")
    discard(sets)
    parts, first = None, 0

    def joined(links: DataFrame, parts: DataFrame | None) -> DataFrame:
        both = links if parts is None else links.unionByName(parts.select(F.col("lo").alias("a"), F.col("component").alias("b")))
        out = components(both).withColumnRenamed("id", "lo")
        discard(parts, links)
        return out

    def checked(pairs: DataFrame, more: DataFrame | None = None) -> DataFrame:
        pairs = stored(pairs, "jaccard-pairs")
        some = likely(pairs, classes)
        some = stored(some if more is None else some.unionByName(more).distinct(), "jaccard-likely")
        links = verified(docs, some, classes)
        discard(pairs, some)
        return links

    # rounds against hubs of other components, while they bring links
    for round_ in range(MAX_ROUNDS):
        before, live = live, stored(live_postings(live, parts, round_), "jaccard-live")
        discard(before)
        links = checked(hub_pairs(live, classes))
        found = links.count()
        parts = joined(links, parts)
        first = first or found
        if found <= FEW * first:
            break
    # what is left in different components: pairs of small shingles, and large ones where their sets meet
    before, live = live, stored(live_postings(live, parts, MAX_ROUNDS), "jaccard-live")
    discard(before)
    large = stored(live.groupBy("token").agg(F.count("*").alias("k")).where(F.col("k") > SMALL).select("token"), "jaccard-large")
    cells = stored(worth_checking(first_meetings(live, large)), "jaccard-cells")
    parts = joined(checked(rest_of_small(live, large, classes), cell_hubs(cells, classes)), parts)
    discard(live, large)
    # the sets of large shingles that this has not brought together
    again = cells.drop("component").join(parts, "lo", "left").withColumn("component", F.coalesce("component", "lo"))
    rest = stored(left_in_cells(again, classes), "jaccard-rest")
    if not rest.isEmpty():
        wanted = rest.select("lo").distinct().join(classes.select("lo", "doc"), "lo")
        items = stored(set_items(docs, wanted).dropDuplicates(["lo"]), "jaccard-items")
        parts = joined(stored(links_in_cells(rest, items), "jaccard-links"), parts)
        discard(items)
    discard(cells, rest)
    return sigs, classes, parts


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text, ...)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs, classes, parts = set_components(docs)
    # rows of one doc_id are one document, whatever their sets
    own = sigs.where("lo is not null and doc_id is not null").select("doc_id", "lo")
    several = own.groupBy("doc_id").agg(F.min("lo").alias("a"), F.max("lo").alias("z")).where("a < z").select("doc_id", "a")
    if not several.isEmpty():
        links = own.join(several, "doc_id").where("lo <> a").select("a", F.col("lo").alias("b"))
        parts = components(links.unionByName(parts.select(F.col("lo").alias("a"), F.col("component").alias("b")))).withColumnRenamed("id", "lo")
    of_set = classes.join(parts, "lo", "left").select("hi", "lo", "doc", F.coalesce("component", "lo").alias("component"))
    smallest = of_set.groupBy("component").agg(F.min("doc").alias("component_id"))
    whole = stored(of_set.join(smallest, "component").select("hi", "lo", "component_id"), "jaccard-result")
    # a document whose rows have words in some and none in others has its component from the former
    by_doc = sigs.select("doc_id", "n_shingles", "hi", "lo").join(whole, ["hi", "lo"], "left")
    discard(classes, parts)
    return by_doc.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, that of the smallest doc_id (all columns kept).

    Rows with different texts under one doc_id are told apart: each stays unless it is the near copy of another row. Rows without
    a doc_id cannot be named as anyone's copy and stay, and so does one row of each doc_id without words."""
    sigs, classes, parts = set_components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = sigs.where("doc_id is not null").select("doc_id", "key", "lo").join(parts, "lo", "left")
    rows = rows.withColumn("component", F.coalesce("component", "lo"))
    heads = (rows.where("lo is not null").groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("h")).select("h.doc_id", "h.key")
             .unionByName(rows.where("lo is null").groupBy("doc_id").agg(F.min("key").alias("key"))))
    heads = stored(heads.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct(), "jaccard-heads")
    discard(classes, parts, sigs)
    named = docs.where("doc_id is not null").withColumn("_text", text_key())
    kept = named.join(heads, (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_text") == F.col("_key")), "left_semi")
    kept = kept.dropDuplicates(["doc_id", "_text"]).select(*docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))


ORACLE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * both_ >= 75 * (p.n + q.n - both_)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS seen FROM documents
  UNION SELECT r.doc_id, y FROM reach r JOIN ways ON x = r.seen)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(seen) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id"""


def op6_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(without(table(spark, sf_dir, "documents"), "n_shingles", "component_id"))
