"""Substring deduplication: repeated passages found by paragraph MinHash banding.

Paragraphs come in two grains. Lines of ``MIN_LINE`` words or more get a MinHash of their 5-word
shingles, cut into bands tuned for high recall at similarity 0.75. Shorter lines in a row, up to a blank or a long
one, count as one line: such text is wrapped, and the same words may be wrapped elsewhere at other columns. Each line is also cut into
short segments at content-defined places (where the hash of a word pair is the smallest among
its neighbours), which fall alike wherever a passage stands, so a passage inside other text is
found too; a segment has one band, its digest. Borders near a passage's ends depend on the words
around it, so passages are also compared word by word, line ends ignored: every ``EXACT`` words
have an anchor (the smallest hash of ``ANCHOR`` words among them), and wherever an anchor is shared all runs
of ``EXACT`` words that have it are compared over all documents. Colliding lines of different words are joined
with hubs of their band, round by round, and all pairs of a band that are still in different components
with each other; exact Jaccard similarity decides. Equal segments need no more.
Similar lines are clustered by connected components; each class of paragraphs keeps its first
place. Matched paragraphs that touch form a run, and only runs of ``MIN_RUN`` words or more count.

Defined results: a NULL, empty or white-space text has no paragraphs; copies of a whole document
are runs like any other; a passage repeated only inside one document does not count; an empty
table gives an empty result. Positions are word numbers of the whole text (words as in ``common.WORD_RE``,
compared with A-Z lower-cased), end exclusive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, discard, scramble, slices, stored, table
from .graph import components
from .jaccard import deal_blocks, live_postings

N_GRAM = 5
SIMILARITY = 0.75
MIN_LINE = 20
MIN_RUN = 38
#: Half width of the window in which a segment border's hash is the smallest.
REACH = 4
LONGEST = 24
#: Shorter segments say nothing by themselves; a run may step over that many words.
SHORTEST = 4
ROWS = 3
RECALL = 0.985
PER_HUB = 2000
#: Lines of one key that are compared with as many others in one place.
PER_BLOCK = 256
#: Shared runs of that many words are found wherever they stand; an anchor has so many words (both sums of powers of 2).
EXACT, ANCHOR = 50, 16
#: Runs of one anchor that are compared in one place; those of a more frequent anchor become rows of their own.
PER_ANCHOR = 1 << 14
#: Rounds against hubs end after so many, or when one brings less than this share of the first one's links.
MAX_ROUNDS, FEW = 8, 0.02
_LINE_END = "\x1e"


def band_count(similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> int:
    """Fewest bands of ``rows`` values that meet a pair of this similarity with this probability."""
    bands = 1
    while 1 - (1 - similarity ** rows) ** bands < recall:
        bands += 1
    return bands


BANDS = band_count()
_KEYS = scramble(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


class Lines:
    """Words of a batch of texts with their document, line and place in the document.

    Lines of fewer than MIN_LINE words that follow each other without a blank one are one line."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(pa.concat_arrays([texts.cast(pa.large_string()), pa.array([], pa.large_string())]), "")
        words = Words(pc.replace_substring(texts, "\n", f" {_LINE_END} "))
        end = pc.index(words.vocab, pa.scalar(_LINE_END, words.vocab.type)).as_py() if len(words.vocab) else -1
        doc = np.repeat(np.arange(len(words.counts)), words.counts)
        mark = words.codes == end
        line = np.cumsum(mark) + doc  # a document's end ends its line
        keep = ~mark
        self.hash = words.hashes()[words.codes[keep]] if keep.any() else np.zeros(0, np.uint64)
        self.doc = doc[keep]
        line = line[keep]
        self.starts = self._joined(line) if len(line) else np.zeros(0, np.int64)
        self.ends = np.concatenate([self.starts[1:], [len(line)]]) if len(line) else self.starts
        first = np.searchsorted(self.doc, np.arange(len(words.counts)))
        self.place = np.arange(len(self.doc)) - first[self.doc] if len(self.doc) else self.doc

    def _joined(self, line: np.ndarray) -> np.ndarray:
        """Starts of the lines, given each word's line number; short neighbours joined."""
        starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        short = np.diff(np.concatenate([starts, [len(line)]])) < MIN_LINE
        goes_on = short[1:] & short[:-1] & (line[starts[1:]] == line[starts[:-1]] + 1) & (self.doc[starts[1:]] == self.doc[starts[:-1]])
        return starts[np.concatenate([[True], ~goes_on])]

    def segments(self) -> np.ndarray:
        """Starts of all segments: line starts, and places whose word pair hash is a local minimum."""
        n = len(self.hash)
        if not n:
            return self.starts
        with np.errstate(over="ignore"):
            pair = np.full(n, ~np.uint64(0))
            pair[1:] = scramble(self.hash[:-1] * np.uint64(3) + scramble(self.hash[1:]))
            pair[self.starts] = ~np.uint64(0)  # a pair does not cross lines
        low = np.ones(n, bool)
        for k in range(1, REACH + 1):
            low[k:] &= pair[k:] < pair[:-k]
            low[:-k] &= pair[:-k] <= pair[k:]
        into = np.arange(n) - np.repeat(self.starts, self.ends - self.starts)
        rest = np.repeat(self.ends, self.ends - self.starts) - np.arange(n)
        low &= (into >= SHORTEST) & (rest >= SHORTEST)
        low[self.starts] = True
        found = np.flatnonzero(low)
        size = np.diff(np.concatenate([found, [n]]))
        long_ = size > 2 * LONGEST  # text that repeats a few words has no minimum: cut it evenly
        extra = (size[long_] - 1) // LONGEST
        base = np.repeat(found[long_], extra)
        step = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        return np.sort(np.concatenate([found, base + step * LONGEST]))

    def digests(self, starts: np.ndarray) -> np.ndarray:
        """A hash of the word sequence of each part."""
        if not len(starts):
            return np.zeros(0, np.int64)
        size = np.diff(np.concatenate([starts, [len(self.hash)]]))
        with np.errstate(over="ignore"):
            at = (np.arange(len(self.hash)) - np.repeat(starts, size)).astype(np.uint64)
            terms = scramble(self.hash ^ scramble(at + np.uint64(1)))
            return scramble(np.add.reduceat(terms, starts) + size.astype(np.uint64)).view(np.int64)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place and number of every group of neighbouring runs of EXACT words with one anchor, and the hash of the
        anchor."""
        n = len(self.hash)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none
        whole = np.searchsorted(self.doc, self.doc, "right") - np.arange(n) >= EXACT
        short = _span_hash(self.hash, ANCHOR)
        # the run's words alone decide which place is its anchor: the first of the smallest
        anchor = _ahead(np.arange(n), EXACT - ANCHOR + 1, lambda a, b: np.where(short[b] < short[a], b, a))
        at = np.flatnonzero(whole)
        first = np.flatnonzero(np.concatenate([[True], anchor[at[1:]] != anchor[at[:-1]]])) if len(at) else at
        size = np.diff(np.concatenate([first, [len(at)]]))
        return at[first], size, short[anchor[at[first]]].view(np.int64)

    def run_hashes(self) -> np.ndarray:
        """The hash of the run of EXACT words at every place."""
        return _span_hash(self.hash, EXACT).view(np.int64) if len(self.hash) else np.zeros(0, np.int64)

    def line_shingles(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes of the given lines (all of N_GRAM words or more) and each line's start among them."""
        s, e = self.starts[lines], self.ends[lines]
        per = e - s - N_GRAM + 1
        begin = np.concatenate([[0], np.cumsum(per)])
        at = np.arange(begin[-1]) + np.repeat(s - begin[:-1], per)
        with np.errstate(over="ignore"):
            out = np.zeros(len(at), np.uint64)
            for k in range(N_GRAM):
                out = out * np.uint64(0x9E3779B97F4A7C15) + scramble(self.hash[at + k] + np.uint64(k + 1))
        return scramble(out), begin


def pair_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number from 0 on for every place, the same where both values are."""
    order = np.lexsort((b, a))
    new = np.zeros(len(order), np.int64)
    new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    code = np.empty(len(order), np.int64)
    code[order] = np.cumsum(new)
    return code


def _shifted(x: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate([x[k:], x[len(x) - min(k, len(x)):]])  # the end is of no whole run


def _span_hash(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` values from each place on, from spans of powers of 2."""
    with np.errstate(over="ignore"):
        join = lambda a, b: scramble(a * np.uint64(0x9E3779B97F4A7C15) + scramble(b))
        out, done, span, width = None, 0, scramble(h + np.uint64(size)), 1
        while width <= size:
            if size & width:
                part = _shifted(span, done)
                out = part if out is None else join(out, part)
                done += width
            span, width = join(span, _shifted(span, width)), width * 2
        return out


def _ahead(x: np.ndarray, size: int, least) -> np.ndarray:
    """``least`` (minimum or maximum) of the ``size`` values from each place on, as far as there are any."""
    width, out = 1, x
    while width * 2 <= size:
        if width < len(x):
            out = np.concatenate([least(out[:-width], out[width:]), out[-width:]])
        width *= 2
    k = size - width
    return np.concatenate([least(out[:-k], out[k:]), out[-k:]]) if 0 < k < len(x) else out


def shared_runs(docs: DataFrame) -> DataFrame:
    """(doc, w0, w1, head): runs of EXACT words or more that other documents have too, with the first
    place (doc, w0) of their words; a run ends where its first place changes.

    The runs of an anchor are one row for each place of the anchor and meet in one place; those of an anchor with more than
    PER_ANCHOR runs become a row each, and their first places an aggregate, so that no place holds a group without bound."""
    docs = docs.where("text is not null and doc_id is not null").select("doc_id", "text")

    def anchor_rows(batches):
        for batch in slices(batches, max_bytes=5_000_000):
            x = Lines(batch.column(1))
            at, size, key = x.runs()
            order = np.lexsort((key, x.doc[at]))
            key, doc, size = key[order], x.doc[at][order], size[order]
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(key) else order
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            n = np.add.reduceat(size, new) if len(key) else size
            yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(ids[doc[new]], pa.int64()), pa.array(n, pa.int32())],
                                             names=["key", "doc", "n"])

    def run_rows(batches):
        for batch in slices(batches, max_bytes=5_000_000):
            x = Lines(batch.column(1))
            at, size, key = x.runs()
            listed = batch.column(2)
            text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
            known, many = (pc.struct_field(listed.flatten(), k).to_numpy(zero_copy_only=False) for k in range(2))
            code = pair_codes(np.concatenate([text, x.doc[at]]), np.concatenate([known, key]))
            state = np.zeros(code.max(initial=-1) + 1, np.int8)  # 1: the anchor is shared, 2: and frequent
            state[code[: len(text)]] = 1 + many.astype(np.int8)
            state = state[code[len(text):]]
            keep = state > 0
            at, size, key, state = at[keep], size[keep], key[keep], state[keep]
            ends = np.concatenate([[0], np.cumsum(size)])
            place = np.arange(ends[-1]) + np.repeat(at - ends[:-1], size)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.run_hashes()[place], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(ids[x.doc[at]], pa.int64()), pa.array(x.place[at], pa.int32()),
                                              runs, pa.array(state == 2)], names=["key", "doc", "w0", "runs", "many"])

    def matched(batches):
        for batch, _ in _parts(batches, limit=1 << 40):
            key, doc, w0 = (batch.column(k).to_numpy() for k in range(3))
            size = pc.list_value_length(batch.column(3)).to_numpy()
            row = np.repeat(np.arange(len(key)), size)
            into = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            run, key, doc, w0 = batch.column(3).flatten().to_numpy(), key[row], doc[row], w0[row] + into
            order = np.lexsort((w0, doc, run, key))
            new = np.concatenate([[True], (key[order[1:]] != key[order[:-1]]) | (run[order[1:]] != run[order[:-1]])]) if len(order) else order > 0
            group = np.cumsum(new) - 1
            start = np.flatnonzero(new)
            last = np.concatenate([start[1:], [len(order)]]) - 1
            several = doc[order[start]] != doc[order[last]] if len(order) else start > 0
            head = np.empty(len(order), np.int64)
            head[order] = order[start][group] if len(order) else head
            met = np.empty(len(order), bool)
            met[order] = several[group]
            yield _merged(doc[met], w0[met], w0[met] + EXACT, doc[head[met]], w0[head[met]], row[met])

    def merge(batches):
        for batch, _ in _parts(batches):
            cols = [batch.column(k).to_numpy() for k in range(5)]
            new = np.ones(len(cols[0]), bool)  # equal rows of a repeated doc_id are one
            new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
            yield _merged(*(c[new] for c in cols))

    places = "doc long, w0 int, w1 int, head_doc long, head_w0 int"
    several = F.min("doc") < F.max("doc")
    anchors = stored(docs.mapInArrow(anchor_rows, "key long, doc long, n int"), "repeats-anchors")
    met = (anchors.groupBy("key").agg(several.alias("_met"), (F.sum("n") > PER_ANCHOR).alias("many")).where("_met").select("key", "many"))
    wanted = stored(on_key(anchors, met).groupBy("doc").agg(F.collect_list(F.struct("key", "many")).alias("keys")), "repeats-wanted")
    texts = docs.join(wanted, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "keys")
    rows = stored(texts.mapInArrow(run_rows, "key long, doc long, w0 int, runs array<long>, many boolean"), "repeats-runs")
    discard(anchors, wanted)
    few = rows.where("not many").select("key", "doc", "w0", "runs").repartition("key").sortWithinPartitions("key")
    single = rows.where("many").select("doc", "w0", F.posexplode("runs").alias("into", "key"))
    single = single.select("key", "doc", (F.col("w0") + F.col("into")).alias("w0"))
    heads = (single.groupBy("key").agg(several.alias("_met"), F.min(F.struct("doc", "w0")).alias("head")).where("_met")
             .select("key", F.col("head.doc").alias("head_doc"), F.col("head.w0").alias("head_w0")))
    single = on_key(single, heads).select("doc", "w0", (F.col("w0") + EXACT).alias("w1"), "head_doc", "head_w0")
    placed = stored(few.mapInArrow(matched, places).unionByName(single), "repeats-placed")
    discard(rows)
    placed = placed.repartition("doc").sortWithinPartitions("doc", "w0", "w1", "head_doc", "head_w0")
    runs = stored(placed.mapInArrow(merge, places), "repeats-shared")
    discard(placed)
    return runs.select("doc", "w0", "w1", F.struct(F.col("head_doc").alias("doc"), F.col("head_w0").alias("w0")).alias("head"))


def _merged(doc, w0, w1, head_doc, head_w0, *same) -> pa.RecordBatch:
    """Sorted runs of EXACT words or more, those joined that go on one word later here and at their first place (and are the ``same``)."""
    start = np.ones(len(doc), bool)
    start[1:] = ((doc[1:] != doc[:-1]) | (w0[1:] != w1[:-1] - EXACT + 1) | (head_doc[1:] != head_doc[:-1])
                 | (head_w0[1:] - w0[1:] != head_w0[:-1] - w0[:-1]))
    for c in same:
        start[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(start)
    last = np.concatenate([first[1:], [len(doc)]]) - 1 if len(first) else first
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((doc[first], w0[first], w1[last], head_doc[first], head_w0[first]), types)],
                                      names=["doc", "w0", "w1", "head_doc", "head_w0"])


def on_key(rows: DataFrame, per_key: DataFrame) -> DataFrame:
    """``rows`` joined with ``per_key``, an aggregate of one row for each key.

    The join is on key and a hash of it, so both sides are shuffled for it and adaptive execution can split the rows of a
    key that very many documents have."""
    deal = F.xxhash64("key")
    return rows.withColumn("_deal", deal).join(per_key.withColumn("_deal", deal), ["key", "_deal"]).drop("_deal")


def paragraph_bands(docs: DataFrame) -> DataFrame:
    """(key, doc, w0, w1, digest): one row per segment (digest NULL) and BANDS per long line."""
    def run(batches):
        for batch in slices(batches, max_bytes=5_000_000):
            x = Lines(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            seg = x.segments()
            if len(seg):
                stop = np.concatenate([seg[1:], [len(x.hash)]])
                digest, some = x.digests(seg), stop - seg >= SHORTEST
                seg, stop = seg[some], stop[some]
                parts.append((digest[some], x.doc[seg], x.place[seg], x.place[stop - 1] + 1, None))
            long_ = np.flatnonzero(x.ends - x.starts >= MIN_LINE)
            if len(long_):
                digest = x.digests(x.starts)[long_]
                h, begin = x.line_shingles(long_)
                with np.errstate(over="ignore"):
                    for b in range(BANDS):
                        key = np.full(len(long_), np.uint64(b + 1))
                        for r in range(ROWS):
                            m = _KEYS[b * ROWS + r]
                            low = np.minimum.reduceat((h * m) ^ ((h * m) >> np.uint64(29)), begin[:-1])
                            key = scramble(key + low)
                        s, e = x.starts[long_], x.ends[long_] - 1
                        parts.append((key.view(np.int64), x.doc[s], x.place[s], x.place[e] + 1, digest))
            for key, doc, w0, w1, digest in parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(ids[doc], pa.int64()), pa.array(w0, pa.int32()), pa.array(w1, pa.int32()),
                     pa.nulls(len(key), pa.int64()) if digest is None else pa.array(digest, pa.int64())],
                    names=["key", "doc", "w0", "w1", "digest"])

    return docs.where("text is not null and doc_id is not null").select("doc_id", "text").mapInArrow(
        run, "key long, doc long, w0 int, w1 int, digest long")


def collisions(bands: DataFrame) -> DataFrame:
    """Rows of keys that several paragraphs have, with their hub (hub_digest NULL: an equal segment).

    Of lines only those are given whose words differ from their hub's; equal ones share segments."""
    def run(batches):
        hub = None  # of the last key: it may go on in the next part
        for batch, _ in _parts(batches):
            key, doc, w0, w1 = (batch.column(k).to_numpy() for k in range(4))
            line = np.asarray(batch.column(4).is_valid())
            digest = pc.fill_null(batch.column(4), 0).to_numpy()
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.concatenate([start, [len(key)]]))
            h = np.stack([digest[start], doc[start], w0[start].astype(np.int64), w1[start].astype(np.int64)])
            goes_on = hub is not None and key[0] == hub[0]
            if goes_on:
                h[:, 0] = hub[1]
            hub = (key[-1], h[:, -1].copy())
            h = np.repeat(h, size, axis=1)
            ends = start + size - 1
            many = np.repeat(doc[ends] != doc[start], size)  # sorted by document
            if goes_on:
                many[: size[0]] = True
            keep = many & (~line | (digest != h[0]))
            cols = [key, doc, w0, w1, digest, h[0], h[1], h[2].astype(np.int32), h[3].astype(np.int32)]
            arrays = [pa.array(c[keep]) for c in cols]
            arrays[4] = pc.if_else(pa.array(line[keep]), arrays[4], pa.scalar(None, pa.int64()))
            arrays[5] = pc.if_else(pa.array(line[keep]), arrays[5], pa.scalar(None, pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "doc", "w0", "w1", "digest", "hub_digest", "hub_doc",
                                                            "hub_w0", "hub_w1"])

    rows = bands.repartition("key").sortWithinPartitions("key", "doc", "w0")
    return rows.mapInArrow(run, "key long, doc long, w0 int, w1 int, digest long, hub_digest long, hub_doc long, "
                                "hub_w0 int, hub_w1 int")


def _parts(batches, limit: int = 1 << 20):
    """Sorted batches as batches that end with a key's last row, unless a key alone passes ``limit`` rows."""
    held = None
    for batch in batches:
        t = batch if held is None or not held.num_rows else pa.concat_batches([held, batch])
        key = t.column(0).to_numpy()
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield t.slice(0, cut), False
        held = t.slice(cut)
        if held.num_rows > limit:
            yield held, True
            held = held.slice(0, 0)
    if held is not None and held.num_rows:
        yield held, False


def line_sets(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(digest, items): the sorted shingle hashes of the lines ``places`` (digest, doc, w0), one place for each digest."""
    jobs = places.groupBy("doc").agg(F.collect_list(F.struct("w0", "digest")).alias("jobs"))
    texts = docs.join(jobs, F.col("doc_id") == F.col("doc")).select("text", "jobs")

    def sets(batches):
        for batch in slices(batches, max_bytes=5_000_000):
            x = Lines(batch.column(0))
            first = np.searchsorted(x.doc, np.arange(batch.num_rows))
            digest = x.digests(x.starts)
            jobs_ = batch.column(1)
            text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(jobs_).to_numpy(zero_copy_only=False))
            w0, named = (pc.struct_field(jobs_.flatten(), k).to_numpy() for k in range(2))
            at = first[text] + w0
            line = np.minimum(np.searchsorted(x.starts, at), max(len(x.starts) - 1, 0))
            if not len(x.starts):
                continue
            same = (x.starts[line] == at) & (digest[line] == named)  # else of another row of this doc_id
            line, named = line[same], named[same]
            for k in range(0, len(line), 2000):
                h, begin = x.line_shingles(line[k:k + 2000])
                items = [np.unique(h[s:e]).tobytes() for s, e in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(named[k:k + 2000]), pa.array(items, pa.binary())], names=["digest", "items"])

    return texts.mapInArrow(sets, "digest long, items binary").dropDuplicates(["digest"])


def verified_lines(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(digest, hub_digest) of the ``pairs`` of line classes whose shingle ``sets`` have Jaccard similarity >= 0.75.

    Sets go to their hub, a hub with many members is checked in several places."""
    pairs = pairs.select("digest", "hub_digest").distinct()
    size = pairs.groupBy("hub_digest").agg(F.count("*").alias("n"))
    size = size.select("hub_digest", (F.floor(F.col("n") / PER_HUB) + 1).cast("int").alias("parts"))
    salt = F.pmod(F.xxhash64("digest"), F.lit(1 << 30))
    member = (pairs.join(size, "hub_digest")
              .select("digest", "hub_digest", (salt % F.col("parts")).cast("int").alias("part"), F.lit(1).alias("is_member")))
    hub = size.select(F.col("hub_digest").alias("digest"), "hub_digest", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"),
                      F.lit(0).alias("is_member"))

    def check(batches):
        now, center = None, None
        for batch in batches:
            out = []
            for hub_, part, is_member, digest, items in zip(*(batch.column(k).to_pylist() for k in range(5))):
                own = np.frombuffer(items, np.uint64)
                if not is_member:
                    now, center = (hub_, part), own
                elif (hub_, part) == now:
                    both = len(np.intersect1d(center, own, assume_unique=True))
                    if both >= SIMILARITY * (len(center) + len(own) - both):
                        out.append((digest, hub_))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                              pa.array([o[1] for o in out], pa.int64())], names=["digest", "hub_digest"])

    placed = member.unionByName(hub).join(sets, "digest").select("hub_digest", "part", "is_member", "digest", "items")
    placed = placed.repartition("hub_digest", "part").sortWithinPartitions("hub_digest", "part", "is_member")
    return placed.mapInArrow(check, "digest long, hub_digest long").distinct()


def crossing_lines(live: DataFrame, sets: DataFrame) -> DataFrame:
    """(digest, hub_digest) of all similar lines that share a key of ``live`` (token, lo, component) in
    different components.

    A large key is checked block with block in many places, and no pair becomes a row unless it links."""
    def check(batches):
        for cell in _cells(batches):
            block, digest, comp = (cell.column(c).to_numpy() for c in ("block", "lo", "component"))
            items = [np.frombuffer(x, np.uint64) for x in cell.column("items").to_pylist()]
            a = np.flatnonzero(block == cell.column("i")[0].as_py())
            b = np.flatnonzero(block == cell.column("j")[0].as_py())
            if not len(a) or not len(b):
                continue
            both = _overlaps(items, a, b)
            n = np.array([len(x) for x in items])
            like = (both >= SIMILARITY * (n[a][:, None] + n[b][None, :] - both)) & (comp[a][:, None] != comp[b][None, :])
            x, y = np.nonzero(like)
            x, y = digest[a[x]], digest[b[y]]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["digest", "hub_digest"])

    dealt = deal_blocks(live, PER_BLOCK)
    rows = dealt.join(sets.withColumnRenamed("digest", "lo"), "lo").select("token", "i", "j", "block", "lo", "component", "items")
    rows = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return rows.mapInArrow(check, "digest long, hub_digest long").distinct()


def _cells(batches):
    """The rows of each (token, i, j) of sorted batches, as one table (two blocks at most)."""
    held = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
        cut = np.flatnonzero(np.concatenate([[True], np.any(names[:, 1:] != names[:, :-1], axis=0)]))
        for at, end in zip(cut, [*cut[1:], batch.num_rows]):
            name = tuple(names[:, at])
            if name != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = name
            held.append(batch.slice(at, end - at))
    if held:
        yield pa.Table.from_batches(held)


def _overlaps(sets: list, a: np.ndarray, b: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sets ``a`` with sets ``b``."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, code = row[n[code] > 1], code[n[code] > 1]
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        lo, hi = np.searchsorted(code, [at, at + width])
        has = np.zeros((len(sets), width), np.float32)
        has[row[lo:hi], code[lo:hi] - at] = 1
        out += has[a] @ has[b].T
    return out


def similar_lines(docs: DataFrame, met: DataFrame) -> DataFrame:
    """(id, component) of every line class that is similar to another, by chains of similar lines.

    First every line against the hub of its key, then against hubs of other components, until that
    brings few links; then all pairs of a key that are still in different components. Texts are read
    once: the shingle sets of all lines that met another are written, one for each class."""
    sides = (met.select(F.col("key").alias("token"), F.col("digest").alias("lo"), "doc", "w0")
             .unionByName(met.select(F.col("key").alias("token"), F.col("hub_digest").alias("lo"), F.col("hub_doc").alias("doc"),
                                     F.col("hub_w0").alias("w0"))))
    places = sides.groupBy(F.col("lo").alias("digest")).agg(F.min(F.struct("doc", "w0")).alias("p")).select("digest", "p.doc", "p.w0")
    sets = stored(line_sets(docs, places), "repeats-sets")
    links = stored(verified_lines(met, sets), "repeats-lines")
    live = stored(sides.select("token", "lo").distinct(), "repeats-live")
    parts = components(links, "digest", "hub_digest")
    first = links.count()
    discard(links)

    def joined(links: DataFrame) -> DataFrame:
        out = components(links.unionByName(parts.select(F.col("id").alias("digest"), F.col("component").alias("hub_digest"))),
                         "digest", "hub_digest")
        discard(parts, links)
        return out

    def still_apart(round_: int) -> DataFrame:
        out = stored(live_postings(live, parts.withColumnRenamed("id", "lo"), round_), "repeats-live")
        discard(live)
        return out

    for round_ in range(MAX_ROUNDS):
        live = still_apart(round_)
        pairs = live.where("component <> hub_component").select(F.col("lo").alias("digest"), F.col("hub").alias("hub_digest"))
        links = stored(verified_lines(pairs, sets), "repeats-lines")
        found = links.count()
        if found:
            parts = joined(links)
        if found <= FEW * first:
            break
    if found:
        live = still_apart(MAX_ROUNDS)
    parts = joined(stored(crossing_lines(live.select("token", "lo", "component"), sets), "repeats-lines"))
    discard(live, sets)
    return parts


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, run_start, run_end, kept_doc, removed, word_start, word_end, n_paragraphs): for every
    long run its paragraphs by the document that keeps them (``removed``: this is not that place)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = stored(collisions(paragraph_bands(docs)), "repeats-met")
    lines = met.where("digest is not null")
    at = (lines.select("digest", "doc", "w0", "w1").unionByName(
        lines.select(F.col("hub_digest").alias("digest"), F.col("hub_doc").alias("doc"), F.col("hub_w0").alias("w0"),
                     F.col("hub_w1").alias("w1"))).distinct())
    parts = similar_lines(docs, lines)
    near = stored(at.join(parts, F.col("digest") == F.col("id"))
                  .select("doc", "w0", "w1", F.struct(F.col("component").alias("a"), F.lit(1).alias("b")).alias("g")), "repeats-near")
    several = near.groupBy("g").agg((F.min("doc") < F.max("doc")).alias("_met")).where("_met").select("g")
    similar = near.join(several, "g").select("doc", "w0", "w1", "g")
    units = (met.where("digest is null").select("doc", "w0", "w1", F.struct(F.col("key").alias("a"), F.lit(0).alias("b")).alias("g"))
             .unionByName(similar))
    none = F.lit(None)
    runs = shared_runs(docs)
    units = (units.withColumn("exact", none.cast("struct<doc: bigint, w0: int>"))
             .unionByName(runs.select("doc", "w0", "w1", none.cast("struct<a: bigint, b: int>").alias("g"), F.col("head").alias("exact"))))
    # runs of touching paragraphs
    order = Window.partitionBy("doc").orderBy("w0", "w1")
    reach = F.max("w1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    units = units.withColumn("_new", F.coalesce(F.col("w0") >= reach + SHORTEST, F.lit(True)).cast("int"))
    units = units.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = Window.partitionBy("doc", "_run")
    units = stored(units.withColumn("run_start", F.min("w0").over(whole)).withColumn("run_end", F.max("w1").over(whole))
                   .drop("_new", "_run"), "repeats-units")
    discard(met, parts, near, runs)
    heads = stored(units.where("g is not null").groupBy("g").agg(F.min(F.struct("doc", "w0")).alias("head")), "repeats-heads")
    long_ = units.where(F.col("run_end") - F.col("run_start") >= MIN_RUN)
    spans = (long_.where("exact is null").join(heads.withColumnRenamed("g", "hg"), F.col("g") == F.col("hg"))
             .select("doc", "w0", "w1", "run_start", "run_end", "head")
             .unionByName(long_.where("exact is not null").select("doc", "w0", "w1", "run_start", "run_end", F.col("exact").alias("head")))
             .withColumn("removed", F.struct("doc", "w0") != F.col("head")))
    out = stored(spans.groupBy(F.col("doc").alias("doc_id"), "run_start", "run_end", F.col("head.doc").alias("kept_doc"), "removed")
                 .agg(F.min("w0").alias("word_start"), F.max("w1").alias("word_end"),
                      F.count("*").alias("n_paragraphs")), "repeats-result")
    discard(units, heads)
    return out


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
