"""Operators across rows against brute force, on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkaudit.llm import components, decontamination, fingerprints, language_model, neardup, queries, sharding

ODD = [(1, "the cat sat"), (2, None), (3, ""), (4, " \t\n"), (5, "a b c " * 10_000), (5, "a b c " * 10_000), (None, "the cat sat")]
FOLDER = "/root/testdata/sf0.001"


def _sets(rows, width):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    return out


def _components(rows, width):
    """Smallest reachable id per row, over all pairs."""
    sets, above = _sets(rows, width), list(range(len(rows)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                above[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return [least.get(top(i)) if sets[i] else rows[i][0] for i in range(len(rows))]


def _near_copies(n, seed=1):
    """Families of near copies with 0 to 30 changed words, one large family, and unrelated rows."""
    rng = random.Random(seed)
    rows = []
    for family in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(30, 200))]
        for _ in range(n if family == 0 else rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_all_pairs(docs, width):
    rows = _near_copies(60) + [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE two"), (1003, "ONE two"), (None, "one  two")]
    found = neardup.find_duplicates(docs(rows), width).collect()
    want = Counter((k, len(s), c, k == c) for (k, _), s, c in zip(rows, _sets(rows, width), _components(rows, width)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == want


def test_large_node_of_near_copies(docs):
    """More near copies than a leaf holds, on every level: the star and the deeper rounds."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        own = list(base)
        own[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(own)))
    rows.append((900, " ".join(base[:225] + [f"z{i}" for i in range(75)])))  # shares much, linked with none
    found = {r.doc_id: r.component_id for r in neardup.find_duplicates(docs(rows)).collect()}
    assert {k: found[k] for k in range(150)} == dict.fromkeys(range(150), 0) and found[900] == 900


def test_one_row_of_each_group_stays(docs):
    rows = [*_near_copies(20), (5001, None), (5002, ""), (5003, " \t\n"), (0, "same row again and again"), (0, "same row again and again")]
    kept = neardup.drop_duplicates(docs(rows))
    assert kept.columns == docs([]).columns
    want = set(_components(rows, 5))
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids) == want and sum(ids.values()) == len(want) + 1  # the id 0 names two groups
    assert neardup.drop_duplicates(docs([])).count() == 0
    assert neardup.drop_duplicates(docs([(1, "a b"), (2, None)])).count() == 2


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(200, 200), (None, 3), (300, 301), (301, 300)]
    table = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in components.components(table).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 131), 100), 300: 300, 301: 300}
    assert components.components(table.limit(0)).count() == 0


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("block", [16_000_000, 60])
def test_matches_equal_a_scan(spark, docs, block):
    rng = random.Random(7)
    texts = [(i, " ".join(rng.choice("abcdé") for _ in range(rng.randint(0, 60)))) for i in range(60)] + ODD
    items = [(i, " ".join(rng.choice("abcdé") for _ in range(rng.randint(3, 9)))) for i in range(8)]
    items += [(20, "the CAT"), (21, None), (22, "..."), (20, "the cat"), (None, "b b"), (23, "b b")]
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find_matches(docs(texts), tests, width=5, keep=["doc_id"], block_bytes=block).collect()
    want = Counter()
    for key, text in texts:
        w, hit, ids = _words(text), set(), set()
        for item, passage in items:
            p = _words(passage)
            size = min(5, len(p))
            for j in range(len(p) - size + 1 if p else 0):
                for i in range(len(w) - size + 1):
                    if w[i : i + size] == p[j : j + size]:
                        hit |= set(range(i, i + size))
                        ids.add(item)
        want[key, len(w), len(hit), tuple(sorted(str(i) for i in ids))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted({str(m.item_id) for m in r.matches}))) for r in found) == want


def test_longest_matches_and_removal(spark, docs):
    tests = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "item_id bigint, text string")
    text = "x " + " ".join(f"w{i}" for i in range(5, 25)) + " y"
    row = decontamination.find_matches(docs([(1, text)]), tests, keep=["doc_id"]).first()
    assert [(m.item_id, m.start, m.n_words) for m in row.matches] == [("1", 1, 20)] and row.n_hit == 20
    left = decontamination.decontaminate(docs([(1, text), (2, None), (3, "w1 w2 w3")]), tests)
    assert {r.doc_id for r in left.collect()} == {2, 3} and left.columns == docs([]).columns
    assert decontamination.decontaminate(docs(ODD), tests.limit(0)).count() == len(ODD)


def test_shards_match_the_mixture(docs):
    rows = [(i, "t") for i in range(997)] + [(None, None), (3, "t"), (3, "t")]
    table = docs(rows).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 7)))
    out = sharding.interleave(table, 8).select("doc_id", "source", "shard", "slot").collect()
    sizes = Counter(r.shard for r in out)
    assert len(out) == 1000 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(n))
    for source in {r.source for r in out}:
        share = Counter(r.shard for r in out if r.source == source)
        assert max(share.get(s, 0) for s in range(8)) - min(share.get(s, 0) for s in range(8)) <= 2
    assert sharding.interleave(docs([]), 8).count() == 0
    singles = docs(rows[:400]).withColumn("source", F.col("doc_id").cast("string"))
    assert set(Counter(r.shard for r in sharding.interleave(singles, 8).collect()).values()) == {50}


def test_fingerprints_equal_brute_force(docs):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 80)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "😀é x"), (103, rows[0][1])]
    out = {r.doc_id: r for r in fingerprints.fingerprints(docs(rows), size=64, chunks=7).collect()}
    order = sorted(rows, reverse=True)
    error = []
    for at, (key, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert out[key].n_chars == len(text) and out[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = Counter(text.split()), Counter(edited.split())
        if a or b:
            error.append(out[key].near_edited - sum((a & b).values()) / sum((a | b).values()))
    assert abs(sum(error) / len(error)) < 0.05 and max(map(abs, error)) < 0.35
    assert out[0].fingerprint == out[103].fingerprint and len({r.fingerprint for r in out.values()}) >= 60
    assert out[100].fingerprint == "" and out[101].near_next == 1.0  # two texts without words


def test_fingerprints_odd_rows(docs):
    assert fingerprints.fingerprints(docs([])).count() == 0
    assert fingerprints.fingerprints(docs([(1, "a b")])).first().near_next == 1.0
    assert fingerprints.fingerprints(docs(ODD), chunks=3).count() == len(ODD)


def test_fingerprints_have_enough_samples(docs):
    """At 32 samples or more the standard error of a likeness is below 0.09."""
    row = fingerprints.fingerprints(docs([(1, "a b c"), (2, "d e f")])).first()
    assert len(row.fingerprint) >= 32 * 8 and len(row.edited_fingerprint) == len(row.fingerprint)


def test_base_scores_and_held_out_gain(spark):
    held = lambda key: zlib.crc32(str(key).encode()) % 7 == 2
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    counts = Counter()
    for r in rows:
        if not held(r.doc_id):
            counts.update([*r.text.encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    texts = {r.doc_id: r.text for r in rows}
    out = queries.queries()["op3_suffix_tree"](spark, FOLDER).collect()
    for r in out:
        tokens = [*texts[r.doc_id].encode().lower().split(), None]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(tokens), sum(counts[t] > 0 for t in tokens), n, held(r.doc_id))
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
    assert sum(r.score for r in out if r.held_out) > sum(r.base_score for r in out if r.held_out)


def test_suffix_tree_is_a_distribution_and_learns_order(docs, monkeypatch):
    trees = []
    build = language_model.SuffixTree.add_level
    monkeypatch.setattr(language_model.SuffixTree, "add_level", lambda self, k, c: (trees.append(self), build(self, k, c))[1])
    rng = random.Random(9)
    rows = []
    for i in range(300):
        words = []
        while len(words) < 40:
            words += ["alpha", "beta", "gamma"] if rng.random() < 0.3 else [rng.choice("pqrstuvw")]
        rows.append((i, " ".join(words)))
    table = docs(rows)
    out = language_model.score(table.where("doc_id >= 250"), table.where("doc_id < 250")).collect()
    assert all(r.score > r.base_score for r in out) and len(trees[0].contexts[0])
    tree = trees[0]
    symbols = language_model.np.arange(len(tree.root))
    for context in tree.contexts[0][:5]:
        rows = language_model.np.stack([language_model.np.full(len(symbols), context), symbols], 1).ravel()
        assert tree.probabilities(rows)[1::2].sum() == pytest.approx(1 + tree.root[0], abs=1e-6)
    odd = language_model.score(docs(ODD), table.limit(0)).collect()
    assert len(odd) == len(ODD) and all(math.isfinite(r.score) and r.train_tokens == 0 for r in odd)


def test_rare_passages_are_learned_at_any_size(docs, monkeypatch):
    """A passage in few of many texts, and every lookup by a join: nothing is cut by its share of the corpus."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(50)]
    fill = lambda: [f"f{min(int(rng.paretovariate(0.6)), 5000)}" for _ in range(400)]
    rows = [(i, " ".join(fill() + (passage if i % 200 == 0 else []))) for i in range(600)]
    table, probe = docs(rows), docs([(1000, " ".join(passage)), (1001, " ".join(rng.sample(passage, 50)))])
    scores = []
    for share in (1e-6, 2.0):
        monkeypatch.setattr(language_model, "HOT_SHARE", share)
        out = {r.doc_id: r for r in language_model.score(probe, table).collect()}
        scores.append([out[i].score for i in (1000, 1001)])
    assert scores[0] == pytest.approx(scores[1])
    # Three occurrences are about 1.2e-5 of the corpus; in order the words cost a fraction of a digit each.
    assert scores[0][0] / 51 > -0.5 and scores[0][1] / 51 < -2


def test_longer_contexts_decide(docs):
    """Which word follows is told by the word four places before; the three in between are always the same."""
    rng = random.Random(5)
    rows = [(i, " ".join(w for _ in range(20) for w in (*rng.choice([("a", "x", "y", "z", "b"), ("c", "x", "y", "z", "d")]),))) for i in range(60)]
    out = {r.doc_id: r.score for r in language_model.score(docs([(1, "a x y z b"), (2, "a x y z d")]), docs(rows)).collect()}
    assert out[1] - out[2] > 1.5


def test_pipeline_stages_against_brute_force(spark):
    con = duckdb.connect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = dict(con.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall())
    kept = corpus_pipeline.good_quality(spark, docs, FOLDER)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns
    assert sum((labels[i] == 1) == (i in ids) for i in labels) >= 0.95 * len(labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    one = corpus_pipeline.one_of_each(spark, docs, FOLDER)
    assert {r.doc_id for r in one.collect()} == set(_components(rows, 5))
    clean = {r.doc_id for r in corpus_pipeline.no_benchmark(spark, docs, FOLDER).collect()}
    want = con.sql(queries.OP5_SQL.replace("FROM documents", f"FROM '{FOLDER}/documents.parquet'").replace("FROM benchmark", f"FROM '{FOLDER}/benchmark.parquet'"))
    assert clean == {r[0] for r in want.fetchall() if not r[5]}
    encoded = corpus_pipeline.tokens(spark, docs.limit(50), FOLDER)
    assert encoded.where("not round_trip").count() == 0


def test_stages_take_an_empty_table(spark):
    none = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        if name != "pii":  # trains for seconds; its empty table is tested with a smaller tagger
            assert stage(spark, none, FOLDER).count() == 0, name


def test_stages_hand_out_small_batches(spark, docs):
    """Long texts reach Python in batches of a few MB, not in one of 10 000 rows or 64 MB; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def run(parts):
        for part in parts:
            yield language_model.pa.RecordBatch.from_arrays([language_model.pa.array([part.nbytes])], names=["n"])

    table = docs([(i, "word " * 20_000) for i in range(200)])
    try:
        out = corpus_pipeline.tokens(spark, table, FOLDER)
        assert out.where("round_trip").count() == 200
        sizes = [r.n for r in table.select("text").coalesce(1).mapInArrow(run, "n bigint").collect()]
        assert sum(sizes) >= 20_000_000 and max(sizes) < 5_000_000
        spark.conf.set(name, "1000000")
        corpus_pipeline.no_benchmark(spark, table, FOLDER)
        assert spark.conf.get(name).rstrip("b") == "1000000"
    finally:
        spark.conf.set(name, before)


def test_lookups_are_asked_after_kept_contexts_only(docs, monkeypatch):
    """A sequence that has a value is joined where its context is kept; words in random order ask for no more than that."""
    asked, written = [], language_model.cut_lineage
    monkeypatch.setattr(language_model, "HOT_SHARE", 2.0)

    def spy(rows):
        out = written(rows)
        asked.extend(r for r in out.select("tokens", "cold").collect()) if "cold" in out.columns else None
        return out

    marks = language_model._marks
    monkeypatch.setattr(language_model, "cut_lineage", spy)
    # A field so full that it tells nothing: the second one, of the kept contexts, must hold.
    monkeypatch.setattr(language_model, "_marks", lambda rows, n: b"\xff" * 1024 if "v" in rows.columns else marks(rows, n))
    rng = random.Random(8)
    language_model.score(docs([(i, " ".join(rng.choice("abcdefgh") for _ in range(50))) for i in range(40)]), docs([(1, "a b c")])).collect()
    assert asked and all(len(r.cold) <= r.tokens + 1 for r in asked)


def test_sequences_are_counted_in_packed_rows(spark, docs):
    """All that occur twice, as by brute force; what is shuffled are rows by bucket, not one for each sequence."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefghijkl") for _ in range(300)) for _ in range(40)] + [None, "", "A b" * 50]
    symbols = language_model.read_symbols(docs(list(enumerate(texts))))
    keys, _, first = language_model._read([t or "" for t in texts])
    assert sorted(r.symbols for r in symbols.collect()) == sorted(x.tolist() for x in language_model.np.split(keys, first[1:]))
    often = spark.sparkContext.broadcast(b"\xff" * 8192)
    found, _ = language_model.count_sequences(symbols, often, 3, 32)
    got = language_model.unpack(found.toArrow(), key=language_model.np.int64, c=language_model.np.int64)
    want = Counter()
    for t in texts:
        words = [0, *(t or "").lower().split(), 1]
        want.update(zip(words, words[1:], words[2:]))
    assert sorted(got[1].tolist()) == sorted(c for c in want.values() if c >= 2) and len(set(got[0].tolist())) == len(got[0])
    assert language_model._sequences(symbols, often, 3, 32, True).count() <= 32 * symbols.rdd.getNumPartitions() < len(want) / 2


def test_word_keys_are_those_of_the_words(monkeypatch):
    """Equal for equal words in any place and case, whatever block they are in; else different."""
    monkeypatch.setattr(language_model, "BLOCK", 64)
    rng = random.Random(7)
    texts = ["", " \t\x0b", "x" * 500 + " X" + "x" * 499, *["".join(rng.choice("aAbé \x1c\n") for _ in range(200)) for _ in range(50)]]
    keys, _, _ = language_model._read(texts)
    words = [w for t in texts for w in (-1, *t.encode().lower().split(), 0)]
    assert len(keys) == len(words) and len(set(zip(keys.tolist(), words))) == len(set(keys.tolist())) == len(set(words))


def test_stages_hand_out_batches_of_one_megabyte(spark, docs):
    """A batch is held several times outside the JVM's heap; four MB were too many for the pipeline's executors."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64000000")
        corpus_pipeline.no_benchmark(spark, docs([(1, "a")]), FOLDER)
        assert int(spark.conf.get(name)) == 1_000_000
    finally:
        spark.conf.set(name, before)


def test_sequences_move_in_turns(docs, monkeypatch):
    """A turn moves its share of the sequences only, all turns together every one, and scores stay."""
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnop") for _ in range(200))) for i in range(30)] + [(90, None), (91, "a b " * 40)]
    symbols = language_model.read_symbols(docs(rows))
    marks = symbols.sparkSession.sparkContext.broadcast(b"\xff" * 8192)

    def moved(**turn):
        rows = language_model._sequences(symbols, marks, 3, 32, True, **turn).toArrow()
        return Counter(language_model.unpack(rows, key=language_model.np.int64)[0].tolist())

    every, shares = moved(), [moved(turn=i, turns=2) for i in range(2)]
    assert shares[0] + shares[1] == every and all(0.2 * len(every) < len(x) < 0.8 * len(every) for x in shares)
    assert not set(shares[0]) & set(shares[1])
    table = docs(rows)
    whole = {r.doc_id: r.score for r in language_model.score(table, table.where("doc_id < 91")).collect()}
    asked = []
    monkeypatch.setattr(language_model, "TURN_TOKENS", 1000)
    step = language_model.back_off
    monkeypatch.setattr(language_model, "back_off", lambda *a: (asked.append(a[3:]), step(*a))[1])
    turned = {r.doc_id: r.score for r in language_model.score(table, table.where("doc_id < 91")).collect()}
    assert {(0, 2), (1, 2)} == set(asked) and turned == pytest.approx(whole, rel=1e-9)
