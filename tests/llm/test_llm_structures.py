"""Runs, chunk-table pieces and Merkle proofs against plain Python, on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from check import compare, connect
from pyspark.sql import functions as F

from sparkaudit.llm import merkle, pieces, queries, runs

FOLDER = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(1, "the cat sat"), (2, None), (3, ""), (4, " \t\n"), (5, "a b c " * 10_000), (5, "a b c " * 10_000), (None, "x\ny " * 20)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _brute_runs(words, min_length=24, min_exponent=3):
    """Every stretch with words q apart equal, for every q, kept where no shorter period spans it."""
    w, out = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.zeros(0), []
    for q in range(1, len(words) // min_exponent + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        for a, b in zip(np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])):
            length = int(b - a + q)
            if length >= max(min_length, min_exponent * q):
                own = w[a : a + length]
                if not any((own[:-r] == own[r:]).all() for r in range(1, q)):
                    out.append((int(a), length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force():
    rng, found = random.Random(0), 0
    for _ in range(1500):
        least, exponent = rng.choice([(24, 3), (6, 2), (5, 3), (2, 2), (9, 2)])
        n, letters = rng.randint(0, 120), rng.choice([1, 2, 3, 20])
        words = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 3:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 3))
                for i in range(a, rng.randint(a, n)):
                    words[i] = words[a + (i - a) % p]
        want = _brute_runs(words, least, exponent)
        assert runs.find_runs(np.array(words, np.int64), least, exponent) == want
        flat, sizes = np.array([*range(1000, 1005), *words], np.int64), np.array([5, n])
        assert not want or 1 in runs.with_repeats(flat, sizes, runs.least_common(least, exponent))
        found += len(want)
    assert found > 1000
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(9, np.int64), 5, 1)


def test_runs_of_long_texts_and_many_blocks():
    for n, p in ((30_000, 1), (30_000, 7), (9_000, 3_000)):
        assert runs.find_runs(np.arange(n) % p) == [(0, n, p)]


def test_positions_keep_their_order():
    rng = random.Random(4)
    numbers = rng.sample(range(100_000), 9_000)
    own = runs.Positions(numbers[0])
    for x in numbers[1:]:
        own.add(x)
    assert list(own) == sorted(numbers) and own.size == 9_000 and len(own.blocks) > 3
    places = sorted(numbers)
    for i in (0, 1, 4_000, 8_998, 8_999):
        assert own.around(places[i]) == (places[i - 1] if i else -1, places[i + 1] if i < 8_999 else -1)


def test_runs_of_odd_rows(docs):
    out = runs.periodic_runs(docs(ODD).withColumn("runs", F.lit("x"))).collect()
    assert len(out) == len(ODD) and out[0].lang == "en"
    by = {r.doc_id: r for r in out}
    assert [by[i].n_words for i in (1, 2, 3, 4)] == [3, 0, 0, 0] and not any(by[i].runs for i in (1, 2, 3, 4))
    assert by[5].runs[0].asDict() == {"start": 0, "length": 30_000, "period": 3} and by[5].collapsed == "a b c"
    assert by[None].collapsed == "x y" and by[1].collapsed == "the cat sat" and by[2].collapsed == ""
    assert runs.periodic_runs(docs([])).count() == 0


def _planted(key, text):
    words = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return [w.decode() for w in words]


def test_op11_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.queries()["op11_periodic_runs"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    with_runs = 0
    for r in rows:
        words = _planted(r.doc_id, texts[r.doc_id])
        found = _brute_runs(words)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r.collapsed_sha256 == sha(_collapsed(words, found))
        with_runs += bool(found)
    assert with_runs > 10


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(library):
    model, rng = pieces.pieces(MODEL), random.Random(1)
    letters = "ab 'stredvlm\n\t\r\x0b\x1c\x85  é漢字😀½Ⅷ_-.,▁<s>0x4\x00́‍"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", " ", "   " * 50, "x" * 5000, "</s> <unk>", "<0x41>", "▁▁a", "漢" * 2000]
    for text in texts:
        ids = library.encode(text)
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32000), 0, 1, 2, 29871, 259]) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids)


def test_pieces_of_odd_rows(docs, library):
    frame = docs(ODD).withColumn("n_tokens", F.lit("x"))
    out = pieces.decode_ids(pieces.encode_texts(frame, MODEL), MODEL).collect()
    assert sorted(r.decoded for r in out) == sorted(t or "" for _, t in ODD)
    assert all(r.token_ids == library.encode(r.text or "") and r.n_tokens == len(r.token_ids) for r in out)
    assert {r.lang for r in out} == {"en"}
    assert pieces.encode_texts(docs([]), MODEL).count() == 0
    assert [r.n_tokens for r in pieces.encode_texts(docs([(1, None), (2, "")]), MODEL).collect()] == [0, 0]


def test_pieces_over_many_batches(docs, library):
    rng = random.Random(8)
    words = ["the", "▁▁", "\0x", "\0", "", "a\nb", "é", "💡", *[f"w{i}" for i in range(300)]]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(400)]
    out = pieces.encode_texts(docs(rows), MODEL, keep=["doc_id", "text"], batch_bytes=3000).collect()
    assert sorted(r.doc_id for r in out) == list(range(400))
    assert all(r.token_ids == library.encode(r.text) for r in out)


def test_op12_equals_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.queries()["op12_chunk_table_pieces"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids))


def _brute_manifest(rows):
    """(key, leaf) -> (subroot, siblings) and the root, by plain recursion over lists."""
    def climb(nodes):
        paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            runs_of = [range(i, min(i + 3, len(nodes))) for i in range(0, len(nodes), 3)]
            for run in runs_of:
                for i in run:
                    for leaf in owners[i]:
                        paths[leaf] += [nodes[j] for j in run if j != i]
            owners = [[x for i in run for x in owners[i]] for run in runs_of]
            nodes = [sha("".join(nodes[i] for i in run)) for run in runs_of]
        return nodes[0], paths

    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0], sha("".join(map(field, r)))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    tops, inside = [], {}
    for name in names:
        leaves = sorted(trees[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subroot, paths = climb([h for _, h in leaves])
        tops.append(subroot)
        inside[name] = (leaves, subroot, paths)
    root, above = climb(tops)
    return root, sorted(
        (str(k), h, subroot, sha("".join(own + above[i])))
        for i, name in enumerate(names) for leaves, subroot, paths in [inside[name]] for (k, h), own in zip(leaves, paths)
    )


@pytest.mark.parametrize("part", [4, 4096])
def test_manifest_equals_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(merkle, "PART", part)
    monkeypatch.setattr(merkle, "SPAN", 2)
    rng = random.Random(part)
    rows = [
        (rng.choice([None, 7, rng.randrange(1000)]), rng.choice([None, "", "a", "-", "é", f"s{rng.randrange(12)}"]), rng.choice([None, "en"]),
         rng.choice([None, 3]), rng.choice([None, "", "two\nlines", f"t{rng.randrange(9)}"]))
        for _ in range(230)
    ]
    rows += [(7, "a", "en", 3, "same")] * 3
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, root string")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    got = merkle.prove(merkle.build(docs, fields)).collect()
    root, want = _brute_manifest(rows)
    assert sorted((str(r.key), r.leaf, r.subroot, r.proof_sha256) for r in got) == want
    assert {r.root for r in got} == {root} and all(r.verified and r.folded_root == root for r in got)


def test_some_rows_prove_alone_and_tampering_shows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    other = merkle.row_hash([*[F.col(c) for c in fields[:-1]], F.when(F.col("doc_id") == 20, F.lit("!")).otherwise(F.col("text"))])
    book = merkle.build(docs, fields, claimed=other)
    every = {r.key: r for r in merkle.prove(book).collect()}
    few = merkle.prove(book, spark.createDataFrame([(20,), (33,), (33,), (-1,)], "key bigint"), with_proofs=True).collect()
    assert sorted(r.key for r in few) == [20, 33]
    for r in few:
        assert r.proof_sha256 == every[r.key].proof_sha256
        steps = [(s.before, s.after) for s in r.proof]
        assert merkle.fold(r.leaf, steps) == r.root and r.verified == (r.key != 20)
    assert sum(not r.verified for r in every.values()) == 1


def test_arms_are_minimal():
    assert merkle.missing(np.arange(9), 9) == []
    assert merkle.missing(np.array([4]), 10) == [(0, 3), (0, 5), (1, 0), (1, 2), (2, 1)]
    assert merkle.missing(np.array([0]), 1) == []
    assert merkle.missing(np.array([9]), 10) == [(2, 0)]


def test_empty_and_single_manifests(spark):
    schema = "doc_id bigint, source string, text string"
    fields = ["doc_id", "source", "text"]
    assert merkle.prove(merkle.build(spark.createDataFrame([], schema), fields)).count() == 0
    (only,) = merkle.prove(merkle.build(spark.createDataFrame([(1, None, None)], schema), fields)).collect()
    assert only.leaf == only.subroot == only.root == sha("1:1--") and only.proof_sha256 == sha("") and only.verified


def test_op13_equals_sql(spark):
    frame = queries.queries()["op13_octopus_manifest"](spark, FOLDER)
    assert compare(frame, connect(FOLDER), queries.oracle_sql()["op13_octopus_manifest"]) == ""
    assert frame.where("not verified").count() > 0
