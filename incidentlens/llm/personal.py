"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. Mentions (runs of digits and separators, words with an at sign)
are the nodes of a CRF over the labels none, email, ip, card, phone: unary potentials from the
mention's shape and, where seen, its base match; chain potentials between neighbouring
mentions; skip potentials between distant mentions of one document that repeat each other or
are alike (same characters, same last digits, same mailbox). Loopy sum-product passes settle
each document; a mention without a base span that ends up labelled becomes an added span.
Weights come from base matches: during training the evidence of a base match is hidden at
random, so the model learns how far shape and equal mentions elsewhere predict a label.

Defined results: a NULL or empty text has no spans; repeated rows are treated alike; an empty
table gives an empty result (and untrained weights add nothing); input columns named like an
output are replaced. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, table, without

KINDS = ("email", "ip", "card", "phone")
#: Training: at most this many documents with a mention (smallest hash of the id first).
MAX_TRAINING_DOCS = 1000
#: A mention becomes an added span from this marginal probability on.
ADD_FROM = 0.5
ROUNDS = 12
#: What the agreement weights (next, same characters, same identifying part) are drawn towards.
AGREEMENT = (0.0, 4.0, 3.0)
OUTPUT = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])*")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_SPACES = frozenset(" \t\n\x0b\x0c\r")
_DIGITS = re.compile("[^0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _at_most_255(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) < 3 or (len(number) == 3 and number <= "255")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base matches, leftmost and non-overlapping per kind, in order."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:  # the local part is the run before the sign, up to the match before
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    # four numbers of a chain at a time, from its start: a chain of n numbers has n // 4 matches
    for m in _NUMBERS.finditer(text):
        if m[0].count(".") < 3:
            continue
        start, parts = m.start(), m[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            own = parts[k:k + 4]
            end = start + sum(map(len, own)) + 3
            if all(_at_most_255(p) for p in own):
                found.append((start, 1, end))
            start = end + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def mentions(text: str) -> list[tuple[int, int]]:
    """Places of everything that might be personal data: at-sign words and runs of 7 digits or more.

    Taken from left to right without overlap, in one pass: the next word with an at sign is found from the sign."""
    out, done = [], 0
    word = at = end = -1  # the next at-sign word: its start, its (first) sign from ``done`` on, its end
    while True:
        if at < done and at != len(text):
            at = text.find("@", done)
            if at < 0:
                at = word = len(text)
            elif at >= end:  # another word
                word = at
                while word > done and text[word - 1] not in _SPACES:
                    word -= 1
                stop = _SPACE.search(text, at)
                end = stop.start() if stop else len(text)
        run = _RUN.search(text, done, max(word, done) + 1 if at < len(text) else len(text))
        run = _RUN.match(text, run.start()) if run and run.start() < max(word, done) else None if at < len(text) else run
        if run is not None:
            if len(_DIGITS.sub("", run[0])) >= 7:
                out.append(run.span())
            done = run.end()
        elif at < len(text):
            out.append((max(word, done), end))
            done = end
        else:
            return out


N_SHAPES = 14


def shape(mention: str) -> list[int]:
    """Numbers of the features that hold."""
    digits = len(_DIGITS.sub("", mention))
    out = [0]
    if "@" in mention:
        out.append(1)
        out.append(2 if "." in mention.rpartition("@")[2] else 3)
        return out
    out.append(4 if mention.startswith("+") else 5)
    out.append(6 if digits < 10 else 7 if digits < 14 else 8 if digits < 20 else 9)
    out.append(10 if mention.count(".") == 3 else 11)
    if " " in mention or "-" in mention or "(" in mention:
        out.append(12)
    if 14 <= digits <= 19 and luhn(_DIGITS.sub("", mention)):
        out.append(13)
    return out


def likeness(mention: str) -> list[str]:
    """Keys that alike mentions share: the characters that count, and the part that identifies."""
    if "@" in mention:
        low = mention.lower().strip("<>()[]{}.,;:!?\"'")
        return ["=" + low, "@" + low.partition("@")[0]]
    digits = _DIGITS.sub("", mention)
    return ["=" + digits, "~" + digits[-7:]]


def graph(texts: list[str], hubs: bool = False):
    """Nodes (document, start, end), their features, base labels and edges of a batch.

    Edges join each mention with the next one (chain) and with the next one of equal likeness
    (skip); with ``hubs`` also every mention without a base label with the first one of each label
    and equal likeness. So a document of n mentions has O(n) edges, and evidence of a base span is
    one edge away from every mention alike."""
    doc, start, end, feats, label, edges, kind = [], [], [], [], [], [], []
    bases = []
    for d, text in enumerate(texts):
        base = base_spans(text) if text else []
        bases.append(base)
        found = mentions(text) if text else []
        last: dict[str, int] = {}
        at = len(edges)
        for k, (s, e) in enumerate(found):
            n = len(doc)
            doc.append(d)
            start.append(s)
            end.append(e)
            feats.append(shape(text[s:e]))
            label.append(next((b[1] + 1 for b in base if b[0] < e and s < b[2]), 0) if base else 0)
            if k:
                edges.append((n - 1, n))
                kind.append(0)
            for key in likeness(text[s:e]):
                if key in last:
                    edges.append((last[key], n))
                    kind.append(1 if key[0] == "=" else 2)
                last[key] = n
        if hubs and base:
            nodes = range(len(doc) - len(found), len(doc))
            keys = [likeness(text[s:e]) for s, e in found]
            known: dict[str, dict[int, int]] = {}
            for n, own in zip(nodes, keys):
                if label[n]:
                    for key in own:
                        known.setdefault(key, {}).setdefault(label[n], n)
            next_to = set(zip(edges[at:], kind[at:])) if known else set()
            for n, own in zip(nodes, keys):
                if not label[n]:
                    for key in own:
                        k = 1 if key[0] == "=" else 2
                        for hub in known.get(key, {}).values():
                            edge = (min(hub, n), max(hub, n))
                            if (edge, k) not in next_to:
                                edges.append(edge)
                                kind.append(k)
    x = np.zeros((len(doc), N_SHAPES))
    for i, fs in enumerate(feats):
        x[i, fs] = 1.0
    return (bases, np.array(doc, np.int64), np.array(start, np.int64), np.array(end, np.int64), x, np.array(label, np.int64),
            np.array(edges, np.int64).reshape(-1, 2), np.array(kind, np.int64))


N_LABELS = len(KINDS) + 1


def unpack(theta: np.ndarray):
    """Unary weights, evidence weight, and agreement weights of the three edge kinds."""
    a = N_SHAPES * N_LABELS
    return theta[:a].reshape(N_SHAPES, N_LABELS), theta[a], theta[a + 1:a + 4]


def start_theta() -> np.ndarray:
    theta = np.zeros(N_SHAPES * N_LABELS + 4)
    theta[0] = 3.0  # without training: nothing is personal data
    theta[-4] = 6.0
    theta[-3:] = AGREEMENT
    return theta


def marginals(theta, x, seen, edges, kind, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of all nodes by loopy sum-product; ``seen``: base label or -1 where hidden or none.

    A base label is certain to the neighbours, however many alike mentions by themselves say none."""
    w, evidence, agree = unpack(theta)
    unary = x @ w
    has = seen > 0
    unary[np.flatnonzero(has), seen[has]] += evidence
    if not len(edges):
        return _softmax(unary)
    src = np.concatenate([edges[:, 0], edges[:, 1]])
    dst = np.concatenate([edges[:, 1], edges[:, 0]])
    strength = np.exp(agree[np.concatenate([kind, kind])])[:, None] - 1.0
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    log_m = np.zeros((len(src), N_LABELS))
    sure = np.flatnonzero(has[src])
    known = np.eye(N_LABELS)[seen[src[sure]]]
    log_m[sure] = (known - 1.0) * np.log(strength[sure] + 1.0)  # at full strength before mentions agree among themselves
    for _ in range(rounds):
        total = unary.copy()
        np.add.at(total, dst, log_m)
        p = _softmax(total[src] - log_m[back])
        p[sure] = known
        m = p * strength + 1.0  # sum over source labels of p * exp(agree if equal)
        new = np.log(np.maximum(m, 1e-12))
        log_m = 0.5 * log_m + 0.5 * (new - new.max(axis=1, keepdims=True))
    total = unary.copy()
    np.add.at(total, dst, log_m)
    return _softmax(total)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(texts: list[str], steps: int = 150, hide: float = 0.3, seed: int = 5) -> np.ndarray:
    """Weights by pseudo-likelihood with randomly hidden evidence (neighbours' base labels are given)."""
    theta = start_theta()
    _, _, _, _, x, label, edges, kind = graph(texts)
    if not len(label) or not label.any():
        return theta
    rng = np.random.default_rng(seed)
    prior = np.zeros_like(theta)
    prior[-3:] = AGREEMENT
    theta = prior.copy()
    src = np.concatenate([edges[:, 0], edges[:, 1]])
    dst = np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.concatenate([kind, kind])
    onehot = np.eye(N_LABELS)[label]
    near = np.zeros((3, len(label), N_LABELS))
    for k in range(3):
        np.add.at(near[k], dst[both == k], onehot[src[both == k]])
    near = np.minimum(near, 2.0)
    m = v = np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, evidence, agree = unpack(theta)
        show = (label > 0) & (rng.random(len(label)) >= hide)
        z = x @ w + sum(agree[k] * near[k] for k in range(3))
        z[show, label[show]] += evidence
        err = onehot - _softmax(z)
        grad = np.concatenate([(x.T @ err).ravel(), [err[show, label[show]].sum()],
                               [(near[k] * err).sum() for k in range(3)]]) / len(label) - 1e-3 * (theta - prior) * np.where(np.arange(len(theta)) >= len(theta) - 3, 30.0, 1.0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + 0.2 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    theta[-3:] = np.maximum(theta[-3:], 0.0)  # alike mentions attract, they never repel
    return theta


def annotate(texts: list[str], theta: np.ndarray) -> list[tuple[list, list]]:
    """Per text its base spans and all spans, each (start, kind number, end) in order."""
    bases, doc, start, end, x, label, edges, kind = graph(texts, hubs=True)
    out = [(b, b) for b in bases]
    open_ = np.flatnonzero(label == 0)
    if not len(open_) or not (label > 0).any():
        return out
    p = marginals(theta, x, np.where(label > 0, label, -1), edges, kind)
    # a span is added only next to the same entity: some alike mention of the document has the label
    partner = np.zeros(p.shape, bool)
    skip = edges[kind > 0]
    reached = np.eye(N_LABELS, dtype=bool)[label] & (label > 0)[:, None]
    while len(skip):  # labels spread along skip edges as far as they go
        before = reached.sum()
        np.logical_or.at(reached, skip[:, 0], reached[skip[:, 1]])
        np.logical_or.at(reached, skip[:, 1], reached[skip[:, 0]])
        if reached.sum() == before:
            break
    partner |= reached
    for i in open_:
        k = int(p[i].argmax())
        if k > 0 and p[i, k] >= ADD_FROM and partner[i, k]:
            d = int(doc[i])
            out[d] = (out[d][0], sorted([*out[d][1], (int(start[i]), k - 1, int(end[i]))]))
    return out


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def training_texts(docs: DataFrame) -> list[str]:
    """Texts to learn from: a bounded number with an at sign or a long number, whole unless very long."""
    some = docs.where(F.col("text").rlike(r"@|[0-9][0-9 ().-]{5,}[0-9]") & (F.length("text") <= 20_000))
    ids = some.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id")).limit(MAX_TRAINING_DOCS)
    texts = some.join(F.broadcast(ids), "doc_id", "left_semi").orderBy("doc_id", "text").select("text").limit(2 * MAX_TRAINING_DOCS)
    return [r["text"] for r in texts.collect()]


def find_personal_data(docs: DataFrame, redact: bool = False) -> DataFrame:
    """``docs`` plus counts of base spans per kind, ``base_sha256``, ``spans`` and ``n_added``; with
    ``redact`` the text has each span replaced by its kind in square brackets."""
    docs = without(docs, *OUTPUT)
    theta = train(training_texts(docs.select("doc_id", "text")))
    fields = [T.StructField(f"n_{k}", T.LongType(), False) for k in KINDS]
    fields += [T.StructField(c, T.StringType(), False) for c in ("base_sha256", "spans")]
    schema = T.StructType([*docs.schema.fields, *fields, T.StructField("n_added", T.LongType(), False)])
    at_text = [f.name for f in docs.schema.fields].index("text")

    def run(batches):
        for batch in slices(batches):
            texts = batch.column(at_text).to_pylist()
            got = annotate(texts, theta)
            counts = [pa.array([sum(1 for s in b if s[1] == k) for b, _ in got], pa.int64()) for k in range(len(KINDS))]
            shas = [hashlib.sha256(written(b).encode()).hexdigest() for b, _ in got]
            columns = list(batch.columns)
            if redact:
                columns[at_text] = pa.array([hidden(t, s) for t, (_, s) in zip(texts, got)], columns[at_text].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, *counts, pa.array(shas, pa.string()), pa.array([written(s) for _, s in got], pa.string()),
                 pa.array([len(s) - len(b) for b, s in got], pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def hidden(text: str | None, spans) -> str | None:
    """The text with every span (overlapping ones as one) replaced by the kind of its first."""
    if not spans:
        return text
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def op5_personal_data(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
