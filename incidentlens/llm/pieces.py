"""SentencePiece encoding and decoding by a streaming Viterbi.

One pass over the characters keeps, for each boundary, the back pointer of the surviving path.
For a unigram model the survivor has the largest sum of piece scores (ties: the earliest start
of the last piece). For a BPE model piece scores are merge ranks, not log-probabilities; there
the potential between neighbouring pieces is hard: a pair survives if merging its characters
gives back that pair (``Vocabulary.compatible``), and the one surviving path is the sequence
that greedy merging makes. ``StreamingViterbi`` holds a window bounded by the longest piece and
commits ids as soon as all surviving paths run through one boundary. Boundaries that no piece
spans (before a space mark, around a line end) always are such points, so a text falls into
short independent segments; equal segments of a batch are encoded once, many side by side.

Defined results: a NULL or empty text has no ids; characters outside the vocabulary become
their UTF-8 byte pieces (or the unknown id, if the model has no byte pieces); a literal space
mark in a text decodes as a space, as in SentencePiece; repeated rows are encoded alike; other
columns pass through, and one named like an output is replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, slices, table, without

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Longer segments go through the streaming form one character at a time.
SIDE_BY_SIDE = 40
#: A vocabulary file is broadcast; larger ones are refused.
MAX_MODEL_BYTES = 64 << 20
NEVER = 1 << 30


class PairTable:
    """Integer keys to int32 values in hash tables: what collides goes to a next, sparse table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys, values = keys.astype(np.uint64), values.astype(np.int32)
        self.tables, shift = [], 64
        while len(keys):
            bits = max(8, int(len(keys)).bit_length() + 2)
            shift = 64 - bits if shift == 64 else max(1, shift - 7)
            slot = self._slot(keys, shift, bits)
            _, first = np.unique(slot, return_index=True)
            key_at, value_at = np.full(1 << bits, ~np.uint64(0)), np.full(1 << bits, -1, np.int32)
            key_at[slot[first]], value_at[slot[first]] = keys[first], values[first]
            self.tables.append((shift, bits, key_at, value_at))
            keys, values = np.delete(keys, first), np.delete(values, first)

    @staticmethod
    def _slot(keys: np.ndarray, shift: int, bits: int) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where there is none."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int32)
        for shift, bits, key_at, value_at in self.tables:
            slot = self._slot(keys, shift, bits)
            np.copyto(out, value_at[slot], where=key_at[slot] == keys)
        return out


class Vocabulary:
    """Pieces, scores, byte pieces and merge trees of a SentencePiece model file."""

    def __init__(self, proto: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(proto)
        spec, kind = model.normalizer_spec, pb.ModelProto.SentencePiece
        if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models with identity normalisation that keep white space are supported")
        if model.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models are supported")
        self.bpe = model.trainer_spec.model_type == 2
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.byte_id, self.piece_id, self.score, self.raw, self.unk = {}, {}, {}, [], 0
        for i, p in enumerate(model.pieces):
            self.raw.append(p.piece.replace(MARK, " ").encode())
            if p.type == kind.BYTE:
                self.byte_id[int(p.piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(p.piece[1:-1], 16)])
            elif p.type == kind.NORMAL:
                self.piece_id[p.piece], self.score[i] = i, float(p.score)
            elif p.type == kind.UNKNOWN:
                self.unk, self.raw[i] = i, " ⁇ ".encode()
            else:
                self.raw[i] = b""
        self.size = len(self.raw)
        self.unk_score = min(self.score.values(), default=0.0) - 10.0
        if self.bpe:
            self._merge_trees()
        self.longest = max(map(len, self.piece_id), default=1)
        self.cuttable = not any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in self.piece_id)
        self._trie()
        self.known: dict[tuple[int, int], bool] = {}

    def fallback(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode()] if len(self.byte_id) == 256 else [self.unk]

    def normal(self, text: str) -> str:
        return self.prefix + text.replace(" ", MARK) if text else ""

    def _merge_trees(self) -> None:
        """The last merge that makes each piece (left, right), when it happens (``time``, in ranks,
        not before its parts), and all pairs of pieces that merge (``pairs``: rank)."""
        order = sorted(set(self.score.values()), reverse=True)
        rank_of = {s: r for r, s in enumerate(order)}
        rank = {p: rank_of[self.score[i]] for p, i in self.piece_id.items()}
        self.left = np.full(self.size + 1, -1, np.int32)  # one more for an unknown character
        self.right = np.full(self.size + 1, -1, np.int32)
        self.time = np.full(self.size + 1, -1, np.int32)
        reachable = {}
        for p in sorted(self.piece_id, key=len):
            i = self.piece_id[p]
            if len(p) > 1:
                parts = list(p)
                while len(parts) > 2:
                    at = min(range(len(parts) - 1), key=lambda k: (rank.get(parts[k] + parts[k + 1], NEVER), k))
                    if parts[at] + parts[at + 1] not in rank:
                        break
                    parts[at:at + 2] = [parts[at] + parts[at + 1]]
                if len(parts) != 2 or not all(x in reachable for x in parts):
                    continue  # merging never makes this piece
                a, b = reachable[parts[0]], reachable[parts[1]]
                self.left[i], self.right[i] = a, b
                self.time[i] = max(rank[p], self.time[a], self.time[b])
            reachable[p] = i
        self.piece_id = reachable
        keys, ranks = [], []
        for p in reachable:
            for cut in range(1, len(p)):
                a, b = reachable.get(p[:cut]), reachable.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    ranks.append(rank[p])
        self.pairs = PairTable(np.array(keys, np.uint64), np.array(ranks))
        self.pair_rank = dict(zip(keys, ranks))

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the characters of two neighbouring pieces ends with these two pieces.

        Backwards in time: undo the later of the two last merges, and look whether the parts that
        then touch would have merged before that (the left one of two equal merges comes first)."""
        got = self.known.get((a, b))
        if got is None:
            until_a = until_b = NEVER
            x, y, got = a, b, True
            while got:
                k = self.pair_rank.get(x << 20 | y, NEVER)
                got = not (k < until_a and k <= until_b and k < NEVER)
                if self.left[x] >= 0 and (self.time[x] > self.time[y] or self.left[y] < 0):
                    until_a, x = int(self.time[x]), int(self.right[x])
                elif self.left[y] >= 0:
                    until_b, y = int(self.time[y]), int(self.left[y])
                else:
                    break
            self.known[a, b] = got
        return got

    def all_compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs at once."""
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        until_a = np.full(len(a), NEVER, np.int32)
        until_b = until_a.copy()
        while len(live):
            k = self.pairs.get(x << 20 | y)
            clash = (k >= 0) & (k < until_a) & (k <= until_b)
            ok[live[clash]] = False
            in_a, in_b = self.left[x] >= 0, self.left[y] >= 0
            step_a = in_a & ((self.time[x] > self.time[y]) | ~in_b)
            step_b = ~step_a & in_b
            go = ~clash & (step_a | step_b)
            until_a = np.where(step_a, self.time[x], until_a)[go]
            until_b = np.where(step_b, self.time[y], until_b)[go]
            x, y = np.where(step_a, self.right[x], x)[go], np.where(step_b, self.left[y], y)[go]
            live = live[go]
        return ok

    def _trie(self) -> None:
        """Character codes and hashed transitions of the prefix tree of all pieces."""
        chars = sorted({c for p in self.piece_id for c in p})
        self.char_codes = np.array([ord(c) for c in chars], np.int64)
        code = {c: i for i, c in enumerate(chars)}
        nodes, keys, piece = {"": 0}, [], [-1]
        for p in sorted(self.piece_id):
            for end in range(1, len(p) + 1):
                if p[:end] not in nodes:
                    nodes[p[:end]] = len(piece)
                    keys.append(nodes[p[: end - 1]] << 24 | code[p[end - 1]])
                    piece.append(-1)
            piece[nodes[p]] = self.piece_id[p]
        self.node_piece = np.array(piece, np.int32)
        self.steps = PairTable(np.array(keys, np.uint64), np.arange(1, len(piece)))

    def matches(self, points: np.ndarray, left: np.ndarray):
        """All pieces in a row of characters; ``left``: characters up to the end of each one's segment.
        Yields (length, places, ids) by length."""
        codes = np.searchsorted(self.char_codes, points)
        codes[codes == len(self.char_codes)] = 0
        codes = np.where(self.char_codes[codes] == points, codes, (1 << 24) - 1)
        at = np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        for length in range(1, self.longest + 1):
            fits = left[at] >= length
            at, node = at[fits], node[fits]
            node = self.steps.get(node << 24 | codes[at + length - 1]).astype(np.int64)
            at, node = at[node >= 0], node[node >= 0]
            if not len(at):
                return
            ids = self.node_piece[node]
            yield length, at[ids >= 0], ids[ids >= 0]


class StreamingViterbi:
    """Feed characters, get ids as early as they are certain.

    Held: characters, scores and back pointers since the last committed boundary. A later piece
    can only start at one of the last ``longest`` boundaries; once their paths all run through
    one boundary, the ids up to it are out."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.reset()
        self.window = 0  # most characters ever held

    def reset(self) -> None:
        self.chars: list[str] = []
        self.best: list[float] = [0.0]
        self.back: list[tuple[int, int]] = [(0, -1)]  # (start, id), id -1: unknown character
        self.before = -1  # the committed piece before the window

    def feed(self, char: str) -> list[int]:
        v = self.v
        self.chars.append(char)
        end = len(self.chars)
        score, link = -np.inf, (end - 1, -1)
        for start in range(max(0, end - v.longest), end):
            got = v.piece_id.get("".join(self.chars[start:end]))
            if got is None or self.best[start] == -np.inf:
                continue
            if v.bpe:
                last = self.back[start][1] if start else self.before
                if last < 0 or v.compatible(last, got):
                    score, link = 0.0, (start, got)
                    break
            elif self.best[start] + v.score[got] > score:
                score, link = self.best[start] + v.score[got], (start, got)
        if char not in v.piece_id and self.best[end - 1] + v.unk_score > score:
            score, link = 0.0 if v.bpe else self.best[end - 1] + v.unk_score, (end - 1, -1)
        self.best.append(score)
        self.back.append(link)
        self.window = max(self.window, end)
        return self._commit() if end >= 2 * v.longest else []

    def _commit(self) -> list[int]:
        end = len(self.chars)
        alive = {k for k in range(max(0, end - self.v.longest + 1), end + 1) if self.best[k] > -np.inf}
        while len(alive) > 1:  # step the farthest boundary back along its path until one is left
            far = max(alive)
            alive.discard(far)
            alive.add(self.back[far][0])
        at = alive.pop()
        if at == 0:
            return []
        out = self._trace(at)
        self.before = self.back[at][1]
        base = self.best[at]
        self.chars = self.chars[at:]
        self.best = [b - base for b in self.best[at:]]
        self.back = [(0, -1)] + [(s - at, i) for s, i in self.back[at + 1:]]
        return out

    def _trace(self, end: int) -> list[int]:
        ids: list[list[int]] = []
        while end > 0:
            start, i = self.back[end]
            ids.append([i] if i >= 0 else self.v.fallback(self.chars[start]))
            end = start
        return [i for part in reversed(ids) for i in part]

    def encode(self, normal: str) -> list[int]:
        out: list[int] = []
        for c in normal:
            out += self.feed(c)
        out += self._trace(len(self.chars))
        self.reset()
        return out


def encode_segments(vocab: Vocabulary, segments: list[str], block: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all segments one after the other, and where each one's begin (n + 1 places)."""
    n = len(segments)
    lengths = np.fromiter(map(len, segments), np.int64, n)
    order = np.argsort(lengths, kind="stable")
    n_short = int(np.searchsorted(lengths[order], SIDE_BY_SIDE, "right")) if vocab.bpe else 0
    one = StreamingViterbi(vocab)
    parts: dict[int, list[int]] = {int(i): one.encode(segments[i]) for i in order[n_short:]}
    counts = np.zeros(n, np.int64)
    blocks = []
    for at in range(0, n_short, block):
        own = order[at:at + block]
        ids, num = _side_by_side(vocab, [segments[i] for i in own], lengths[own])
        counts[own] = num
        for k in np.flatnonzero((ids == vocab.size).any(axis=1)):
            out, pos = [], 0
            for x in ids[k, : num[k]][::-1].tolist():
                out += [x] if x < vocab.size else vocab.fallback(segments[own[k]][pos])
                pos += len(vocab.raw[x].decode()) if x < vocab.size else 1
            parts[int(own[k])] = out
        blocks.append((own, ids, num))
    for i, p in parts.items():
        counts[i] = len(p)
    starts = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(starts[-1], np.int32)
    for own, ids, num in blocks:
        for j in range(ids.shape[1]):  # the j-th id from the end
            has = np.flatnonzero((num > j) & (counts[own] == num))
            out[starts[own[has]] + num[has] - 1 - j] = ids[has, j]
    for i, p in parts.items():
        out[starts[i]:starts[i + 1]] = p
    return out, starts


def _side_by_side(vocab: Vocabulary, segments: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The surviving paths of many short segments at once: reversed ids (``size``: an unknown
    character) and their number. Boundary e of all segments is settled in step e."""
    n, width = len(segments), int(lengths.max(initial=0))
    points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    first = np.cumsum(lengths) - lengths
    seg = np.repeat(np.arange(n), lengths)
    pos = np.arange(len(points)) - first[seg]
    ends, starts, ids, owners, single = [], [], [], [], np.zeros(len(points), bool)
    for length, at, got in vocab.matches(points, lengths[seg] - pos):
        ends.append(pos[at] + length)
        starts.append(pos[at])
        ids.append(got)
        owners.append(seg[at])
        if length == 1:
            single[at] = True
    lone = np.flatnonzero(~single)  # characters without a piece
    ends, starts = np.concatenate([*ends, pos[lone] + 1]), np.concatenate([*starts, pos[lone]])
    ids = np.concatenate([*ids, np.full(len(lone), vocab.size)]).astype(np.int64)
    owners = np.concatenate([*owners, seg[lone]])
    by_end = np.argsort(ends, kind="stable")
    ends, starts, ids, owners = ends[by_end], starts[by_end], ids[by_end], owners[by_end]
    upto = np.searchsorted(ends, np.arange(1, width + 2))
    last = np.full((n, width + 1), -1, np.int64)  # last piece of the surviving path to each boundary
    back = np.zeros((n, width + 1), np.int64)
    for end in range(1, width + 1):
        a, b = upto[end - 1], upto[end]
        s, i, o = starts[a:b], ids[a:b], owners[a:b]
        before = last[o, s]
        ok = (s == 0) | (before == vocab.size) | (i == vocab.size)
        test = np.flatnonzero(~ok & (before >= 0))
        key = before[test] << 20 | i[test]
        pairs, where = np.unique(key, return_inverse=True)
        ok[test] = vocab.all_compatible(pairs >> 20, pairs & ((1 << 20) - 1))[where]
        last[o[ok], end], back[o[ok], end] = i[ok], s[ok]
    out = np.full((n, width), -1, np.int64)
    num, at, every = np.zeros(n, np.int64), lengths.copy(), np.arange(n)
    for j in range(width):
        live = at > 0
        if not live.any():
            break
        out[live, j] = last[every[live], at[live]]
        at[live] = back[every[live], at[live]]
        num += live
    return out[:, : int(num.max(initial=0))], num


def encode_texts(vocab: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and where each text's begin."""
    if vocab.cuttable:
        cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n").findall
        lists = [cut(vocab.normal(t)) if t else [] for t in texts]
    else:
        lists = [[vocab.normal(t)] if t else [] for t in texts]
    per = np.fromiter(map(len, lists), np.int64, len(lists))
    coded = pa.array([s for x in lists for s in x], pa.large_string()).dictionary_encode()
    del lists
    ids, starts = encode_segments(vocab, coded.dictionary.to_pylist())
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(starts)[codes]
    ends = np.cumsum(size)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - size), size)
    bounds = np.concatenate([[0], np.cumsum(per)])
    return ids[place], np.concatenate([[0], ends])[bounds]


def decode_ids(vocab: Vocabulary, ids) -> str:
    """The text of one id sequence; the dummy prefix is taken off again."""
    raw = vocab.raw
    text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if vocab.prefix and text.startswith(" ") else text


def load(path: str = MODEL_PATH) -> Vocabulary:
    with open(path, "rb") as f:
        proto = f.read(MAX_MODEL_BYTES + 1)
    if len(proto) > MAX_MODEL_BYTES:
        raise ValueError("the vocabulary file is too large to broadcast")
    return Vocabulary(proto)


def encode(docs: DataFrame, model_path: str = MODEL_PATH, column: str = "text") -> DataFrame:
    """``docs`` plus ``ids`` (array of int) and ``n_tokens``."""
    docs = without(docs, "ids", "n_tokens")
    shared = Shared(docs.sparkSession, load(model_path))
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
                           T.StructField("n_tokens", T.LongType(), False)])

    def run(batches):
        vocab = shared.get()
        for batch in slices(batches, max_bytes=6_000_000):
            ids, bounds = encode_texts(vocab, batch.column(column).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(np.diff(bounds), pa.int64())],
                                             names=[*batch.schema.names, "ids", "n_tokens"])

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str = MODEL_PATH, column: str = "ids") -> DataFrame:
    """``rows`` plus ``decoded``, the text of ``column`` (NULL ids: NULL)."""
    rows = without(rows, "decoded")
    shared = Shared(rows.sparkSession, load(model_path))
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        vocab = shared.get()
        for batch in slices(batches, max_bytes=8_000_000):
            lists = batch.column(column)
            flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
            out, at = [], 0
            for size in sizes.tolist():
                out.append(None if size < 0 else decode_ids(vocab, flat[at:at + size].tolist()))
                at += max(size, 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())],
                                             names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs))
    return both.select("doc_id", "n_tokens", "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))
