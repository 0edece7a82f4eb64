from __future__ import annotations

import hashlib
import random
import re

from incidentlens.llm import personal as p


def brute(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


def test_base_spans_equal_brute_force():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "Z", "@", ".", "1", "25", "411111", "+", "-", " ", "(", ")", "é", "@b.c", "\n", "%"])
                       for _ in range(rng.randint(0, 30)))
        assert p.base_spans(text) == brute(text), text


def texts():
    rng = random.Random(0)
    return [f"call +1 (0{i % 10}7) 555-77{i % 90 + 10} or mail a{i}.b@mail{i}.example.com now {rng.randint(10**15, 10**16 - 1)}"
            for i in range(200)]


def test_alike_mentions_take_the_label_and_clean_texts_stay_clean():
    theta = p.train(texts())
    repeated = "mail Bob.x@example.com, later bob.x@example; call +1 (017) 555-7713 or 017 555-7713. Order 1234567890."
    clean = "Order 1234567890123456, version 1.2.3, room 5551234567, user at example."
    (base, spans), (none_, all_) = p.annotate([repeated, clean], theta)
    assert [repeated[s:e] for s, _, e in sorted(set(spans) - set(base))] == ["bob.x@example;", "017 555-7713"] or \
        [repeated[s:e] for s, _, e in sorted(set(spans) - set(base))] == ["017 555-7713"]
    assert none_ == all_ == []


def test_odd_rows(spark, odd, none):
    rows = [(i, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    got = p.find_personal_data(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        base = brute(r["text"] or "")
        assert r["base_sha256"] == hashlib.sha256(p.written(base).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(b[1] == k for b in base) for k in range(4)]
        assert set(filter(None, p.written(base).split(","))) <= set(r["spans"].split(","))
    assert p.find_personal_data(none).count() == 0
    hidden = p.find_personal_data(docs, redact=True).where("doc_id = 5 and n_email = 1").first()["text"]
    assert "[EMAIL]" in hidden and "[PHONE]" in hidden and "@" not in hidden


def test_evidence_reaches_every_alike_mention_of_a_long_document():
    """Numbers of this shape alone say none; before, messages ended twelve edges from the base span."""
    theta = p.train(texts() + [f"room 0{i % 90 + 10} {1234 + i * 7} {8765 - i * 3} is free" for i in range(8)])
    for before, after in ((0, 1), (0, 30), (30, 0), (100, 100)):
        text = "call 020 7946 0958 now. " * before + "call +44 20 7946 0958 now. " + "call 020 7946 0958 now. " * after
        base, spans = p.annotate([text], theta)[0]
        assert len(base) == 1 and len(spans) == 1 + before + after
    assert p.annotate(["room 020 7946 0958 now. " * 40], theta)[0] == ([], [])


def test_one_pass_scans_equal_the_patterns_they_stand_for():
    mention = re.compile(r"[^\x20\x09-\x0D]*@[^\x20\x09-\x0D]*|\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])*")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(1)
    for _ in range(20000):
        t = "".join(rng.choice("0123456 .-()+@a\n") for _ in range(rng.randint(0, 40)))
        assert p.mentions(t) == [m.span() for m in mention.finditer(t)
                                        if "@" in m[0] or len(re.sub("[^0-9]", "", m[0])) >= 7]
        assert [x for x in p.base_spans(t) if x[1] == 1] == [
            (m.start(), 1, m.end()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]


def test_long_unbroken_texts():
    import time

    for text in ("a" * 10 ** 6, "1" * 10 ** 6, "日" * 10 ** 6, "1." * 500_000, "a@" * 500_000):
        start = time.perf_counter()
        p.mentions(text)
        p.base_spans(text)
        assert time.perf_counter() - start < 5  # a fraction of a second on an idle machine
    assert p.base_spans("1.1.1." + "9" * 5000) == []
    assert p.base_spans("0.0.0." + "0" * 5000) == [(0, 1, 5006)]
