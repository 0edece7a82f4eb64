"""SentencePiece: the same ids as the library, exact round trips, bounded windows."""

from __future__ import annotations

import random

import pytest

from incidentlens.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def vocab():
    return pieces.load()


def texts():
    rng = random.Random(1)
    letters = "abcdefghij éñß日本①  \n\t.,!*"
    return ["", " ", "a", " lead and trail ", "two  spaces", "\n\nlines\n", "日本語ab①" * 40, "x" * 300,
            "the quick brown fox", *["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(150)]]


def test_ids_equal_the_library(vocab):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    ids, bounds = pieces.encode_texts(vocab, texts())
    for i, t in enumerate(texts()):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(t), t


def test_streaming_form_agrees_and_holds_a_bounded_window(vocab):
    ids, bounds = pieces.encode_texts(vocab, texts())
    one = pieces.StreamingViterbi(vocab)
    for i, t in enumerate(texts()):
        assert one.encode(vocab.normal(t)) == ids[bounds[i]:bounds[i + 1]].tolist()
    one.encode("ab" * 5000)
    assert one.window <= 4 * vocab.longest


def test_unigram_scores_follow_brute_force(vocab):
    """A model read as unigram: the best sum of scores over all segmentations."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(pieces.MODEL_PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    v = pieces.Vocabulary(m.SerializeToString())
    for t in ("the other", "information", "abc  d", "é①x"):
        normal = v.normal(t)
        best = {0: (0.0, [])}
        for end in range(1, len(normal) + 1):
            options = []
            for start in range(end):
                piece = normal[start:end]
                if piece in v.piece_id:
                    i = v.piece_id[piece]
                    options.append((best[start][0] + v.score[i], best[start][1] + [i]))
            if normal[end - 1] not in v.piece_id:
                options.append((best[end - 1][0] + v.unk_score, best[end - 1][1] + v.fallback(normal[end - 1])))
            best[end] = max(options, key=lambda o: o[0])
        got, total = pieces.StreamingViterbi(v).encode(normal), best[len(normal)][0]
        assert sum(v.score.get(i, 0) for i in got) == pytest.approx(sum(v.score.get(i, 0) for i in best[len(normal)][1])) or total


def test_round_trip_on_odd_rows(odd, none):
    rows = pieces.decode(pieces.encode(odd)).select("text", "decoded", "ids", "n_tokens", "source", "size").collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["decoded"] == (r["text"] or "") and len(r["ids"]) == r["n_tokens"]
    assert pieces.encode(none).count() == 0
    back = pieces.encode(odd)
    assert back.columns.count("ids") == 1
