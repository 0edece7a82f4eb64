"""LM scoring by a gated recurrent language model with a class-factored output softmax.

Every token's probability is P(class | state) * P(token | class, state). The ``HEAD`` most
frequent training words form classes of ``PER_CLASS`` words with a softmax of their own; the end
of a text is a class; all other words fall into classes by the look of their ending, inside which
they weigh as counted in training (plus 0.5, and one unseen word per class). The state is a GRU
over the classes read so far. It is trained in numpy by truncated back-propagation: in each
round every partition trains on its share of the training documents from the same weights, and
the weights are averaged by trained tokens. Scoring carries the state over windows, so a
document has its complete log-likelihood.

Counts cover every training document. Head words (a bounded number) travel with the model; the
counts of all others meet the documents in a join on the word, so the vocabulary may grow
without bound.

Defined results: a NULL or empty text is its end token alone; a NULL doc_id counts as training;
repeated rows each count in training and score alike; an empty table gives an empty result;
without training documents every word is unknown and the weights stay as initialised.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, Words, discard, slices, stored, table

HEAD, PER_CLASS, HIDDEN = 1024, 32, 16
#: So many most frequent words (the head among them) have their counts travel with the model; the
#: counts of all others, of which no word is frequent, meet the documents in a join.
CARRIED = 40_000
#: Tail classes: ending letters (hashed) by the mark that follows them.
ENDINGS, MARKS = 24, 4
N_HEAD = HEAD // PER_CLASS
END_CLASS = N_HEAD
N_CLASSES = N_HEAD + 1 + ENDINGS * MARKS
#: Training: rounds of averaging; each trains on its own share of the training documents, together on all.
ROUNDS = 8
STEPS, LANES = 24, 192
SCORE_LANES, SCORE_STEPS = 192, 32
LN10 = np.log(10.0)
#: Least probability of a class, or of a word in its class (float32).
TINY = 1e-37
#: So many softmax rows at once, which stay in a core's cache.
ROWS = 1024


def looks(vocab: pa.Array) -> np.ndarray:
    """Tail class (0 .. ENDINGS * MARKS - 1) of each word."""
    core = pc.utf8_rtrim(vocab, characters=".,;:!?*#$%&|<>\"')")
    last = pc.utf8_slice_codeunits(vocab, -1)
    mark = np.where(pc.equal(core, vocab).to_numpy(zero_copy_only=False), 0,
                    np.where(pc.equal(last, ".").to_numpy(zero_copy_only=False), 1,
                             np.where(pc.equal(last, ",").to_numpy(zero_copy_only=False), 2, 3)))
    ends = pc.utf8_slice_codeunits(core, -2).dictionary_encode()
    group = np.array([zlib.crc32(e.encode()) % ENDINGS for e in ends.dictionary.to_pylist()] or [0])
    return mark * ENDINGS + group[ends.indices.to_numpy(zero_copy_only=False)]


class Model:
    """Weights (one flat vector), head words and class totals."""

    def __init__(self, common: list[tuple[str, int]], tail: np.ndarray, n_end: int, seed: int = 3):
        head = common[:HEAD]
        self.words = [w for w, _ in head]
        self.common = pa.array([w for w, _ in common], pa.large_string())
        self.common_counts = np.array([c for _, c in common], float)
        self.counts = np.array([c for _, c in head] + [0] * (HEAD - len(head)), float)
        self.n_end = n_end
        self.tail_mass = tail  # per tail class: sum of count + 0.5 over its words, plus 0.5
        rng = np.random.default_rng(seed)
        h, c = HIDDEN, N_CLASSES
        class_mass = np.concatenate([self.counts.reshape(N_HEAD, PER_CLASS).sum(1) + 0.5, [n_end + 0.5], tail])
        inside = np.log(self.counts.reshape(N_HEAD, PER_CLASS) + 0.01)
        inside[self.counts.reshape(N_HEAD, PER_CLASS) == 0] = -30.0
        parts = [rng.normal(0, 0.3, (c, 3 * h)), rng.normal(0, 0.2, (h, 3 * h)), np.zeros((h, c)), np.log(class_mass / class_mass.sum()),
                 np.zeros((N_HEAD, h, PER_CLASS)), inside]
        parts[0][:, :h] += 1.5  # remember long at first
        self.shapes = [p.shape for p in parts]
        self.theta = np.concatenate([p.ravel() for p in parts]).astype(np.float32)

    def parts(self, theta: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for s in self.shapes:
            n = int(np.prod(s))
            out.append(theta[at:at + n].reshape(s))
            at += n
        return out

    def tokens(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Class and place in the class (-1 outside the head) of each word of ``words.vocab``."""
        if not len(words.vocab):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = self.rank(words)
        head = (at >= 0) & (at < HEAD)
        return np.where(head, at // PER_CLASS, N_HEAD + 1 + looks(words.vocab)), np.where(head, at % PER_CLASS, -1)

    def rank(self, words: Words) -> np.ndarray:
        """Place among the carried words (-1: none of them) of each word of ``words.vocab``."""
        at = pc.index_in(words.vocab, value_set=self.common)
        return pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def sequences(model: Model, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes and places of all texts one after the other, each with its end token, and the lengths."""
    n = len(words.counts)
    cls, place = model.tokens(words)
    ends = words.starts[1:] + np.arange(n)
    total = len(words.codes) + n
    c, p = np.full(total, END_CLASS, np.int16), np.full(total, -1, np.int16)
    is_word = np.ones(total, bool)
    is_word[ends] = False
    c[is_word], p[is_word] = cls.astype(np.int16)[words.codes], place.astype(np.int16)[words.codes]
    return c, p, words.counts + 1


class Lanes:
    """Documents laid end to end on parallel lanes of near equal length, longest lane first."""

    def __init__(self, lengths: np.ndarray, lanes: int):
        loads = [(0, k) for k in range(min(lanes, max(1, len(lengths))))]
        own: list[list[int]] = [[] for _ in loads]
        for d in np.argsort(-lengths, kind="stable").tolist():
            load, k = heapq.heappop(loads)
            own[k].append(d)
            heapq.heappush(loads, (load + int(lengths[d]), k))
        own.sort(key=lambda ds: -sum(int(lengths[d]) for d in ds))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        rows = [np.concatenate([np.arange(starts[d], starts[d + 1]) for d in ds]) if ds else np.zeros(0, np.int64) for ds in own]
        self.sizes = np.array([len(r) for r in rows])
        self.index = np.full((int(self.sizes.max(initial=0)), len(rows)), -1, np.int64)  # (step, lane) -> token
        for k, r in enumerate(rows):
            self.index[: len(r), k] = r
        self.first = np.zeros(int(starts[-1]), bool)
        self.first[starts[:-1]] = True


def squash(x: np.ndarray) -> None:
    """The logistic function of ``x``, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1.0
    np.reciprocal(x, out=x)


def gates_of(x: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gates and new states of a step from what the input (``x``, changed) and the state (``b``) give to them."""
    gates, new = x[: 2 * HIDDEN], x[2 * HIDDEN:]
    gates += b[: 2 * HIDDEN]
    squash(gates)
    new += gates[HIDDEN:] * b[2 * HIDDEN:]
    np.tanh(new, out=new)
    return gates, new


def bounded(w: np.ndarray, b: np.ndarray) -> bool:
    """Whether exp of no logit overflows, nor of all of a softmax vanishes, for any state (whose values are within -1 and 1)."""
    reach = np.abs(w).sum(axis=-2)
    return bool((b + reach).max() < 60 and (b - reach).max(axis=-1).min() > -60)


def with_bias(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weights of a softmax, a row for each outcome, the bias as one more unit (whose state is 1)."""
    return np.ascontiguousarray(np.concatenate([np.swapaxes(w, -1, -2), b[..., None]], axis=-1))


def with_ones(states: np.ndarray) -> np.ndarray:
    """(unit, step, lane) of (step, unit, lane) states, as (unit, token), and a last unit of ones."""
    steps, units, n = states.shape
    out = np.empty((units + 1, steps, n), states.dtype)
    out[:units] = np.swapaxes(states, 0, 1)
    out[units] = 1.0
    return out.reshape(units + 1, -1)


def exp_columns(logits: np.ndarray, safe: bool) -> np.ndarray:
    """exp of logits, in place, one softmax in each column, not yet divided by its sum; returns one over the sums."""
    if not safe:
        logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    return 1.0 / logits.sum(axis=0)


def score_tokens(model: Model, c: np.ndarray, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log of P(class) times, for head words, P(word | class) of every token."""
    wx, u, wc, bc, ww, bw = model.parts(model.theta)
    # one row for each unit: numpy's loops then run along lanes, not along a few units
    of_wx, of_u = (np.ascontiguousarray(x.T) for x in (wx, u))
    of_class, of_head = with_bias(wc, bc), with_bias(ww, bw)
    safe_class, safe_head = bounded(wc, bc), bounded(ww, bw)
    lanes = Lanes(lengths, SCORE_LANES)
    out = np.zeros(len(c), np.float64)
    previous = np.concatenate([np.array([END_CLASS], c.dtype), c[:-1]])
    h = np.zeros((HIDDEN, lanes.index.shape[1]), np.float32)
    for at in range(0, len(lanes.index), SCORE_STEPS):
        live = int((lanes.sizes > at).sum())
        tok = lanes.index[at:at + SCORE_STEPS, :live]
        h = h[:, :live]
        states = np.empty((len(tok), HIDDEN, live), np.float32)
        safe = np.maximum(tok, 0)
        read, on = previous[safe], (~lanes.first[safe]).astype(np.float32)
        for t in range(len(tok)):
            gates, new = gates_of(np.take(of_wx, read[t], axis=1), of_u @ np.multiply(h, on[t], out=states[t]))
            h = states[t]
            h -= new
            h *= gates[:HIDDEN]
            h += new
        keep = tok >= 0
        s, own = with_ones(states), tok.ravel()
        if not keep.all():
            s, own = s[:, keep.ravel()], own[keep.ravel()]
        kinds = c[own]
        for i in range(0, len(own), ROWS):
            want = kinds[i:i + ROWS]
            prob = of_class @ s[:, i:i + ROWS]
            share = exp_columns(prob, safe_class)
            out[own[i:i + ROWS]] = np.log(prob[want, np.arange(len(want))] * share + TINY)
        head = np.flatnonzero(p[own] >= 0)
        head = head[np.argsort(kinds[head], kind="stable")]
        s_head, inner = np.take(s, head, axis=1), np.empty((PER_CLASS, len(head)), np.float32)
        for k, b, e in zip(*_spans(kinds[head])):
            inner[:, b:e] = of_head[k] @ s_head[:, b:e]
        share = exp_columns(inner, safe_head)
        out[own[head]] += np.log(inner[p[own[head]], np.arange(len(head))] * share + TINY)
    return out


def _spans(sorted_values: np.ndarray):
    if not len(sorted_values):
        return [], [], []
    begin = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return sorted_values[begin].tolist(), begin.tolist(), np.append(begin[1:], len(sorted_values)).tolist()


def loss_and_gradient(model: Model, theta, c_in, c_out, p_out, first, h0):
    """One truncated window (steps, lanes): mean log loss, its gradient, and the last state.

    Tokens with class -1 are padding."""
    wx, u, wc, bc, ww, bw = model.parts(theta)
    grad = np.zeros_like(theta)
    g_wx, g_u, g_wc, g_bc, g_ww, g_bw = model.parts(grad)
    steps, n = c_in.shape
    # one row for each unit: numpy's loops then run along lanes, not along a few units
    of_wx, of_u = (np.ascontiguousarray(x.T) for x in (wx, u))
    of_class, of_head = with_bias(wc, bc), with_bias(ww, bw)
    on = (~first).astype(theta.dtype)
    inner_of, recurrent = np.empty((steps, 3 * HIDDEN, n), theta.dtype), np.empty((steps, HIDDEN, n), theta.dtype)
    before, states = np.empty_like(recurrent), np.empty_like(recurrent)
    h = h0.T
    for t in range(steps):
        was, now = np.multiply(h, on[t], out=before[t]), states[t]
        b = of_u @ was
        recurrent[t] = b[2 * HIDDEN:]
        inner_of[t] = np.take(of_wx, c_in[t], axis=1)
        g, new = gates_of(inner_of[t], b)
        np.subtract(was, new, out=now)
        now *= g[:HIDDEN]
        now += new
        h = now
    keep = (c_out >= 0).ravel()
    whole = bool(keep.all())
    count = max(1, int(keep.sum()))
    s, co, po = with_ones(states), c_out.ravel(), p_out.ravel()
    if not whole:
        s, co, po = s[:, keep], co[keep], po[keep]
    loss, g_s, safe = 0.0, np.empty((HIDDEN, len(co)), theta.dtype), bounded(wc, bc)
    g_class = np.zeros((HIDDEN + 1, N_CLASSES), theta.dtype)
    for at in range(0, len(co), ROWS):
        part, want = s[:, at:at + ROWS], co[at:at + ROWS]
        prob = of_class @ part
        share = exp_columns(prob, safe)
        cols = np.arange(len(want))
        loss -= np.log(prob[want, cols] * share + TINY).sum()
        prob[want, cols] -= 1.0 / share  # less the wanted class; each column still to be divided by its sum
        share /= count
        g_class += (part * share) @ prob.T
        np.multiply(wc @ prob, share, out=g_s[:, at:at + ROWS])
    g_wc += g_class[:HIDDEN]
    g_bc += g_class[HIDDEN]
    head = np.flatnonzero(po >= 0)
    head = head[np.argsort(co[head].astype(np.uint8 if N_CLASSES <= 256 else np.int64), kind="stable")]
    if len(head):
        kinds, begin, end = _spans(co[head])
        s_head, g_head, inner = np.take(s, head, axis=1), np.empty((HIDDEN, len(head)), theta.dtype), np.empty((PER_CLASS, len(head)), theta.dtype)
        for k, b, e in zip(kinds, begin, end):
            inner[:, b:e] = of_head[k] @ s_head[:, b:e]
        share = exp_columns(inner, bounded(ww, bw))
        cols, own = np.arange(len(head)), po[head]
        loss -= np.log(inner[own, cols] * share + TINY).sum()
        inner[own, cols] -= 1.0 / share
        share /= count
        s_head *= share
        for k, b, e in zip(kinds, begin, end):
            g_own = s_head[:, b:e] @ inner[:, b:e].T
            g_ww[k] += g_own[:HIDDEN]
            g_bw[k] += g_own[HIDDEN]
            g_head[:, b:e] = ww[k] @ inner[:, b:e]
        g_head *= share
        g_s[:, head] += g_head
    if not whole:
        full = np.zeros((HIDDEN, steps * n), theta.dtype)
        full[:, keep] = g_s
        g_s = full
    g_states = np.ascontiguousarray(np.swapaxes(g_s.reshape(HIDDEN, steps, n), 0, 1))
    # what a unit of gradient at a state is at each gate's input; the last two: of the new state, by way of the old one and straight
    z, r, new = (inner_of[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
    factor = np.empty((steps, 4, HIDDEN, n), theta.dtype)
    to_z, to_r, to_b, to_new = (factor[:, k] for k in range(4))
    np.subtract(1.0, z, out=to_z)
    np.multiply(new, new, out=to_new)
    np.subtract(1.0, to_new, out=to_new)
    to_new *= to_z
    np.multiply(to_new, r, out=to_b)
    np.subtract(1.0, r, out=to_r)
    to_r *= to_b
    to_r *= recurrent
    to_z *= z
    to_z *= before - new
    g_h = np.zeros((HIDDEN, n), theta.dtype)
    for t in range(steps - 1, -1, -1):
        g_h += g_states[t]
        here = factor[t]
        here *= g_h  # from here on the gradient itself
        to_state = here[:3].reshape(3 * HIDDEN, n)
        g_u += before[t] @ to_state.T
        g_h *= z[t]
        g_h += u @ to_state
        g_h *= on[t]
    flat = c_in.ravel()
    by = np.argsort(flat.astype(np.uint8 if N_CLASSES <= 256 else np.int64), kind="stable")
    kinds, begin, _ = _spans(flat[by])
    to_b[:] = to_new
    to_input = np.moveaxis(factor[:, :3], 0, 2).reshape(3 * HIDDEN, -1)
    g_wx[kinds] += np.add.reduceat(np.take(to_input, by, axis=1), begin, axis=1).T
    return loss / count, grad, np.ascontiguousarray(h.T)


def stream(lengths: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, cut into equally long lanes, so that every training window is full however long
    a text is: tokens as (step, lane), -1 behind the last, and whether a token is the first of its text.
    What a lane begins within a text starts from a zero state."""
    total = int(lengths.sum())
    width = max(1, min(lanes, total // STEPS))
    tokens = np.full(width * -(-total // width), -1, np.int64)
    tokens[:total] = np.arange(total)
    begins = np.zeros(total, bool)
    begins[np.cumsum(lengths) - lengths] = True
    return tokens.reshape(width, -1).T, begins


def train_on(model: Model, theta: np.ndarray, batches, rate: float) -> tuple[np.ndarray, int]:
    """Adam over the windows of all batches of (classes, places, lengths); tokens trained on."""
    theta = theta.copy()
    m, v, step, seen = np.zeros_like(theta), np.zeros_like(theta), 0, 0
    for c, p, lengths in batches:
        if not len(lengths):
            continue
        tokens, begins = stream(lengths, LANES)
        previous = np.concatenate([np.array([END_CLASS], c.dtype), c[:-1]])
        h = np.zeros((tokens.shape[1], HIDDEN), np.float32)
        for at in range(0, len(tokens), STEPS):
            tok = tokens[at:at + STEPS]
            safe = np.maximum(tok, 0)
            _, grad, h = loss_and_gradient(model, theta, previous[safe], np.where(tok >= 0, c[safe], -1),
                                           p[safe], begins[safe], h)
            norm = float(np.sqrt((grad ** 2).sum()))
            if norm > 1.0:
                grad /= norm
            step += 1
            seen += int((tok >= 0).sum())
            m = 0.9 * m + 0.1 * grad
            v = 0.99 * v + 0.01 * grad ** 2
            theta -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return theta, seen


def with_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, k, held_out, text): k tells rows of one doc_id apart by their text."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), held.alias("held_out"), "text")


def count_words(docs: DataFrame) -> DataFrame:
    """(word, look, c) over all training texts."""
    def run(batches):
        for batch in slices(batches, max_bytes=10_000_000, rows=4000):
            words = Words(batch.column(0))
            n = np.bincount(words.codes, minlength=len(words.vocab))
            if len(words.vocab):
                some = n > 0
                yield pa.RecordBatch.from_arrays(
                    [words.vocab.cast(pa.string()).filter(pa.array(some)), pa.array(looks(words.vocab)[some], pa.int32()),
                     pa.array(n[some], pa.int64())], names=["word", "look", "n"])

    rows = docs.where("not held_out").select("text").mapInArrow(run, "word string, look int, n long")
    return rows.groupBy("word", "look").agg(F.sum("n").alias("c"))


def frequent_words(counts: DataFrame, most: int = CARRIED) -> list[tuple[str, int]]:
    """At most ``most`` words, the most frequent first: all that reach the lowest count level (eight
    levels for each doubling) above which there are no more. No task hands on more than these."""
    level = F.floor(F.log2("c") * 8)
    cut, total = None, 0
    for r in sorted(counts.groupBy(level.alias("b")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["b"]):
        if total + r["n"] > most:
            break
        cut, total = r["b"], total + r["n"]
    if cut is None:
        return []
    rows = counts.where(level >= F.lit(cut)).select("word", "c").collect()
    return sorted(((r["word"], r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def by_round(docs: DataFrame) -> DataFrame:
    """The training documents with their round, stored by it, so that a round reads no others' texts."""
    round_ = F.pmod(F.xxhash64("k", F.lit(7)), F.lit(ROUNDS)).cast("int").alias("round")
    return stored(docs.where("not held_out").select("doc_id", "text", round_), "lm-rounds", by="round")


def share(dealt: DataFrame, round_: int) -> DataFrame:
    """The training documents of a round (of ``by_round``); every one is in exactly one round."""
    return dealt.where(F.col("round") == round_)


def train(docs: DataFrame, model: Model) -> Model:
    """Rounds of local training, each on its share of the training documents, and averaging of the weights."""
    spark = docs.sparkSession
    dealt = by_round(docs)
    for round_ in range(ROUNDS):
        shared = Shared(spark, model)
        part = share(dealt, round_).select("text")
        rate = 0.03 / (1 + round_)

        def run(batches):
            here = shared.get()
            found = (sequences(here, Words(b.column(0))) for b in slices(batches, max_bytes=3_000_000, rows=1000))
            theta, seen = train_on(here, here.theta, found, rate)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(theta)), pa.int32()), pa.array(theta.astype(np.float64) * seen),
                     pa.array(np.full(len(theta), seen), pa.int64())], names=["i", "x", "seen"])

        mean = part.mapInArrow(run, "i int, x double, seen long").groupBy("i").agg((F.sum("x") / F.sum("seen")).alias("x"))
        theta = model.theta.copy()
        for r in mean.collect():  # one number per weight
            theta[r["i"]] = r["x"]
        model.theta = theta
    discard(dealt)
    return model


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = with_keys(docs)
    counts = stored(count_words(docs), "lm-counts")
    n_end = docs.where("not held_out").count()
    common = frequent_words(counts)
    head = common[:HEAD]
    words_, v, mass = 0, 0, np.full(ENDINGS * MARKS, 0.5)
    for r in counts.groupBy("look").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():  # one row per tail class
        mass[r["look"]] += r["c"] + 0.5 * r["v"]
        words_, v = words_ + r["c"], v + r["v"]
    if head:
        for (w, c), look in zip(head, looks(pa.array([w for w, _ in head], pa.large_string()))):
            mass[look] -= c + 0.5
    train_tokens = words_ + n_end
    base_total = float(np.log10(train_tokens + 0.5 * (v + (n_end > 0) + 1)))
    model = train(docs, Model(common, mass, n_end))
    shared = Shared(spark, model)

    def tails(batches):
        here = shared.get()
        for batch in slices(batches, max_bytes=8_000_000):
            words = Words(batch.column(1))
            if not len(words.vocab):
                continue
            rest = np.flatnonzero(here.rank(words)[words.codes] < 0)
            doc = np.repeat(np.arange(batch.num_rows), words.counts)[rest]
            pair, n = np.unique(doc * len(words.vocab) + words.codes[rest], return_counts=True)
            k = batch.column(0).to_numpy(zero_copy_only=False)[pair // len(words.vocab)]
            yield pa.RecordBatch.from_arrays(
                [words.vocab.cast(pa.string()).take(pa.array(pair % len(words.vocab))), pa.array(k, pa.int64()), pa.array(n, pa.int32())],
                names=["word", "k", "n"])

    pairs = docs.select("k", "text").mapInArrow(tails, "word string, k long, n int")
    known = counts.select("word", "c")
    seen = F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(0.5))
    tail = (pairs.join(known, "word", "left").groupBy("k")
            .agg(F.sum(seen).alias("logs"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
                 F.sum("n").alias("tail")))

    def score(batches):
        here = shared.get()
        log_mass = np.log10(here.tail_mass)
        for batch in slices(batches, max_bytes=8_000_000, rows=4000):
            words = Words(batch.column(3))
            c, p, lengths = sequences(here, words)
            doc = np.repeat(np.arange(batch.num_rows), lengths)
            logp = score_tokens(here, c, p, lengths) / LN10
            in_tail = c > END_CLASS
            logp[in_tail] -= log_mass[c[in_tail] - END_CLASS - 1]
            # log10(count + 0.5) of the end and of all carried words; those of tail classes weigh by it
            own = np.concatenate([np.log10(here.common_counts + 0.5), [0.0]])
            rank = here.rank(words) if len(words.vocab) else np.zeros(0, np.int64)
            base, carried = np.full(len(c), np.log10(here.n_end + 0.5)), c == END_CLASS
            base[~carried] = own[rank][words.codes]
            carried[~carried] = (rank >= 0)[words.codes]
            logp += np.where(in_tail, base, 0.0)
            in_tail = ~carried
            add = lambda w: np.bincount(doc, weights=w, minlength=batch.num_rows)
            known_ = carried & ((c != END_CLASS) | (here.n_end > 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(lengths, pa.int64()),
                 pa.array(add(in_tail).astype(np.int64)), pa.array(add(known_).astype(np.int64)),
                 pa.array(add(base)), pa.array(add(logp))],
                names=["doc_id", "k", "held_out", "n_tokens", "n_tail", "n_head", "base", "model"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.mapInArrow(score, f"doc_id {kind}, k long, held_out boolean, n_tokens long, n_tail long, n_head long, "
                                    "base double, model double")
    joined = scored.join(tail, "k", "left")
    share = F.when(F.col("n_tail") > 0, F.col("n_tail") / F.col("tail")).otherwise(0.0)  # below 1 for repeated rows
    logs = F.coalesce(F.col("logs") * share, F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_head") + F.coalesce(F.round(F.col("known") * share), F.lit(0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(base_total)).alias("base_score"),
        (F.col("model") + logs).alias("score"))


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
