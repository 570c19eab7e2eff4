"""Operators on single texts against plain Python, on odd rows."""

import gc
import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkaudit.llm import bpe, pii, quality, secrets, tagger, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, "the cat sat"), (2, None), (3, ""), (4, " \t\n"), (5, "a " * 30_000), (5, "a " * 30_000), (None, "the cat sat")]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary.read(PATH))


def test_ids_equal_the_library(encoder):
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    rng = random.Random(1)
    letters = "ab 'stredvlm\n\t\r\x0b\x1c\x85  é漢字😀½Ⅷ_-.,"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "  ", "x" * 5000, "don't we'll", "a<|endoftext|> b<|endoftext|>", "\x00", "ab" * 3000]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, want):
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert bpe.decode(packed, encoder.vocabulary.tokens) == library.decode(ids, skip_special_tokens=False) == text


def test_pairs_are_compatible_where_merging_says_so(encoder):
    rng = random.Random(2)
    ids = sorted(encoder.alone)
    for _ in range(4000):
        a, b = rng.choice(ids[:3000]), rng.choice(ids[:3000])
        joined = encoder.merged(encoder.vocabulary.tokens[a] + encoder.vocabulary.tokens[b])
        assert encoder.compatible(a, b) == (joined == [a, b])


def test_a_word_is_encoded_once_whatever_follows_it(monkeypatch):
    """And what is remembered stays bounded, with the same ids."""
    own = bpe.Encoder(bpe.Vocabulary.read(PATH))
    solved, solve = [], own.pre_token_ids
    own.pre_token_ids = lambda data: (solved.append(data), solve(data))[1]
    own.encode("zqxw zqxwv, zqxwv. zqxwv; zqxwv! zqxwv")
    assert solved.count(b" zqxwv") == 1
    text = " ".join(f"w{i % 37}x{i % 11}{'.,;'[i % 3]}" for i in range(2000))
    want = own.encode(text)
    monkeypatch.setattr(bpe, "MEMO_PIECES", 20)
    own.forget()
    assert own.encode(text) == want and len(own.memo) + len(own.older) <= 20


def test_encode_odd_rows(docs):
    out = bpe.decode_ids(bpe.encode_texts(docs(ODD), PATH), PATH).collect()
    assert sorted(r.decoded for r in out) == sorted(t or "" for _, t in ODD)
    assert all(len(r.token_ids) == 4 * r.n_tokens for r in out)
    assert bpe.encode_texts(docs([]), PATH).count() == 0


def _base_pii(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and sum(v - 9 if v > 9 else v for v in twice) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_pii_equals_the_patterns():
    rng = random.Random(3)
    texts = ["".join(rng.choice("a@.b-+1 209()x%_5") for _ in range(rng.randint(0, 80))) for _ in range(8000)]
    for text in [*texts, "a@b.c_d@e.f", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "300.1.1.1 é 8.8.8.8", "1" * 3000, "a" * 3000 + "@"]:
        assert pii.base_spans(text) == _base_pii(text)


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    own = tagger.Tagger.new(5, hidden=3, embed=4)
    own.weights = {k: rng.standard_normal(v.shape) * 0.5 for k, v in own.weights.items()}
    codes, tags, lengths = rng.integers(1, 99, (3, 6)), rng.integers(0, 5, (3, 6)), np.array([6, 4, 1])
    codes[1, 4:] = codes[2, 1:] = 0
    _, grads = own.step(codes, lengths, tags)
    for name, weight in own.weights.items():
        at = (codes[0, 0], 1) if name == "embed" else tuple(rng.integers(0, s) for s in weight.shape)
        kept = weight[at]
        weight[at] = kept + 1e-4
        above = own.step(codes, lengths, tags)[0]
        weight[at] = kept - 1e-4
        below = own.step(codes, lengths, tags)[0]
        weight[at] = kept
        assert (above - below) / 2e-4 == pytest.approx(grads[name][at], abs=2e-3)


@pytest.fixture(scope="module")
def trained():
    return pii._trained(("a plain text of words without numbers and some more of it",), 1500, 5)


def test_pii_odd_rows_and_masking(docs, trained):
    rows = [*ODD, (7, "mail bob@example.com or +1 (234) 555-0199, 10.0.0.1"), (8, "nothing here in 1999"), (9, "é bob@example.com")]
    out = {r.doc_id: r for r in pii.find_pii(docs(rows), trained).collect()}
    assert [(s.kind, s.start, s.end) for s in out[7].pii if s.base] == _base_pii(rows[-3][1])
    assert [s.start for s in out[9].pii if s.base] == [2]
    assert out[2].pii == out[3].pii == out[8].pii == []
    masked = pii.mask_pii(docs(rows), trained)
    assert masked.columns == docs([]).columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[7] == "mail <EMAIL> or <PHONE>, <IP>" and texts[2] is None and texts[8] == rows[-2][1]
    assert pii.find_pii(docs([]), trained).count() == 0


def test_windows_are_reconciled_over_a_long_stretch(trained):
    text = "1 " * 400 + "bob@example.com"
    assert len(pii.stretches(text)) == 1
    for kind, start, end, sure in pii.tagged_spans([text], trained)[0]:
        assert 0 <= start < end <= len(text) and 0 < sure <= 1 and kind in pii.KINDS


def _base_secrets(text):
    out = [
        ("assign", *m.span()) for m in re.finditer(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A
        ) if len(m[2]) >= 6
    ]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_secrets_equal_the_patterns():
    rng = random.Random(4)
    bits = ["password", "PassWd", "token", "api_key", "ApiKey", "secret", " = ", ":", "'", '"', "abc", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef", " ", "x", "é", "K"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert secrets.base_spans(text) == _base_secrets(text)


def test_guess_cost_is_the_cheapest_segmentation():
    cost = secrets.GuessCost(["the", "password", "monkey", "dragon"])
    assert cost.bits("password") < cost.bits("p4ssw0rd") < cost.bits("xkqzvwjy")
    assert cost.bits("aaaaaaaaaaaa") < 15 and cost.bits("qwertyuiop") < 30 and cost.bits("1999-12-31") < 16
    assert cost.bits("monkeydragon") < cost.bits("monkey") + cost.bits("dragon") + 2
    assert cost.bits("x8Kp2!vQz7Lm") > 45 and cost.bits("") == 0


def test_secrets_odd_rows(docs):
    rows = [*ODD, (7, "my password is x8Kp2!vQz7Lm. token: abcdef1234"), (8, "the secret is patience"), (9, "login: monkey")]
    table = docs(rows)
    words = secrets.common_words(table)
    assert words[0] in ("the", "cat", "sat") and secrets.common_words(docs([])) == []
    out = {r.doc_id: r.secrets for r in secrets.find_secrets(table, words).collect()}
    assert [(s.kind, s.base) for s in out[7]] == [("guess", False), ("assign", True)]
    assert out[2] == out[3] == out[8] == out[9] == []


def test_ordinal_grades(spark, docs):
    rng = random.Random(5)
    words = {0: "junk", 1: "fair", 2: "good", 3: "best"}
    rows = [(i, " ".join(rng.choice([words[i % 4], "and", "of", "it"]) for _ in range(60))) for i in range(400)]
    ratings = spark.createDataFrame([(i, i % 4) for i, _ in rows] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    model = quality.fit(docs(rows), ratings)
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    fresh = [(g, " ".join(rng.choice([words[g], "and", "of", "it"]) for _ in range(60))) for g in range(4)]
    out = {r.doc_id: r for r in quality.grade(docs([*fresh, (8, None), (9, "")]), model).collect()}
    assert [round(out[g].expected_grade) for g in range(4)] == [0, 1, 2, 3]
    assert out[8].expected_grade == out[9].expected_grade
    kept = quality.select(docs([*fresh, (8, None)]), model)
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3} and kept.columns == docs([]).columns
    assert 0 not in {r.doc_id for r in kept.collect()}


def test_ordinal_gradient_and_empty_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.fit(docs([(1, "a")]), none)
    assert quality.select(docs([(1, "a"), (2, None)]), model).count() == 2
    one = quality.OrdinalModel.fit(["a", "b"], [1, 1])
    assert one.grades == [1] and len(one.thresholds) == 0


def test_toxicity_held_out(spark, docs):
    rng = random.Random(6)
    syllables = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in "lmnrst"]

    def text(toxic):
        out = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(150)]
        for _ in range(6 if toxic else 0):
            out.insert(rng.randrange(len(out)), rng.choice(["zzubwort", "qixxfool"]))
        return " ".join(out)

    rows = [(i, text(i % 4 == 0)) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs(rows), labels)
    out = [(r.doc_id, r.toxicity) for r in toxicity.score(docs(rows), model).collect() if r.doc_id >= 400]
    right = sum((s >= 0.5) == (i % 4 == 0) for i, s in out)
    assert right >= 0.95 * len(out)
    odd = toxicity.score(docs(ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.toxicity <= 1 for r in odd)
    none = toxicity.fit(docs(rows), labels.limit(0))
    assert toxicity.score(docs([(1, "a"), (2, None)]), none).count() == 2


def test_digest_of_span_queries_is_by_code_point():
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert Counter(k for k, _, _ in pii.base_spans("é a@b.cd")) == {"email": 1}


def test_an_idle_encoder_holds_the_vocabulary_alone():
    """Numbers for pairs, not tuples; what was learnt from texts goes with forget()."""
    import tracemalloc

    tracemalloc.start()
    try:
        own = bpe.Encoder(bpe.Vocabulary.read(PATH))
        own.forget()
        gc.collect()
        before = tracemalloc.get_traced_memory()[0]
        rng = random.Random(4)
        own.encode(" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 12))) for _ in range(20_000)))
        own.forget()
        gc.collect()
        assert before < 24_000_000 and tracemalloc.get_traced_memory()[0] - before < 200_000
    finally:
        tracemalloc.stop()
