"""The pipeline's stages against plain versions of their decisions."""

import hashlib
import os
import random

import corpus_pipeline
from shelfwise.llm import decontaminate, jaccard
from shelfwise.llm.common import sifted
from test_llm_operators import brute_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    return docs


def test_stages_decide(spark, tmp_path):
    rng = random.Random(3)
    words = ["v%d" % k for k in range(200)]
    prose = [" ".join(rng.choices(words, k=60)) for _ in range(40)]
    item = " ".join(rng.choices(words, k=14))
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(prose)]
    rows += [(100, prose[3], "en", "s", 1), (101, f"{prose[4]} {item}", "en", "s", 1), (102, None, None, None, None), (103, "", "en", "s", 0)]
    rows += [(104, "my password = hunter2hunter2 ok", "en", "s", 31)]
    toxic = [(200 + k, " ".join(rng.choices(words, k=30)) + " vile vile vile scum", "en", "s", 1) for k in range(60)]
    folder = str(tmp_path / "in")
    docs = write(spark, folder, rows + toxic)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(r[0], 1, 0) for r in rows] + [(r[0], 1, 1) for r in toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    kept = dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, folder)
    assert kept.columns == COLUMNS
    ids = {r["doc_id"] for r in kept.collect()}
    assert {r[0] for r in rows} <= ids and len(ids & {r[0] for r in toxic}) <= 6

    one = jaccard.one_of_each(docs)
    groups = brute_groups([(r[0], r[1]) for r in rows + toxic])
    assert {r["doc_id"] for r in one.collect()} == {d for d, (_, c) in groups.items() if d == c}

    clean = decontaminate.without_contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in clean.collect()} == {101}

    final = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert 100 not in final and 101 not in final and 102 in final and 103 in final
    assert final[104]["decoded_sha256"] == hashlib.sha256(b"my [SECRET] ok").hexdigest()
    assert final[0]["decoded_sha256"] == hashlib.sha256(prose[0].encode()).hexdigest()
    assert final[102]["n_tokens"] == 0


def test_near_copies_have_four_fifths_of_five_words(spark, tmp_path):
    rng = random.Random(7)
    words = ["u%d" % k for k in range(300)]
    texts = []
    for _ in range(12):
        origin = rng.choices(words, k=rng.randint(30, 120))
        texts.append(origin)
        texts.append(origin + rng.choices(words, k=len(origin) * 15 // 100))
        texts.append(origin + rng.choices(words, k=len(origin) * 35 // 100))
        for changed in (1, 2, 4):
            copy = list(origin)
            for _ in range(changed):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    texts += [rng.choices(words, k=n) for n in (1, 4, 5, 6)]
    texts += [texts[-1] + ["u1"], texts[-2] + ["u1"], texts[-4][:]]
    rng.shuffle(texts)
    sets = []
    for w in texts:
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)})
    group = list(range(len(sets)))
    for b in range(len(sets)):
        for a in range(b):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    docs = spark.createDataFrame([(k, " ".join(w), "en", "s", 1) for k, w in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == set(group)


def test_stages_keep_columns_of_any_name_and_empty_tables(spark, tmp_path):
    extra = ["_id", "_h", "_m", "_key", "row", "least", "again", "m", "gone", "score", "spans", "hits", "items", "n", "id", "h", "key"]
    folder = str(tmp_path)
    item = " ".join(f"w{k}" for k in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    texts = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, item), (4, "x token = abcd1234efgh"), (4, "x token = abcd1234efgh"), (5, None), (None, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    docs = spark.createDataFrame([(d, t, "en", "s", 1, *extra) for d, t in texts], schema)
    left = {"toxicity": 7, "ngram_jaccard": 5, "decontamination": 6, "secrets": 7}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert len(rows) == left[name] and all(r[c] == c for r in rows for c in extra)
        assert stage(spark, docs.limit(0), folder).collect() == []
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, folder).count() == 7 and last(spark, docs.limit(0), folder).count() == 0


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "secrets", "byte_bpe"]


def stored(spark):
    """Labels of what lies in the shared folder."""
    return sorted(name.rsplit("-", 1)[0] for name in os.listdir(spark.conf.get("spark.checkpoint.dir")) if "-" in name)


def test_stages_leave_no_intermediates_and_move_few_texts(spark, tmp_path):
    """What a stage wrote on its way goes before the next one runs, and texts of rows that stay are not shuffled."""
    rng = random.Random(17)
    words = ["z%d" % k for k in range(400)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(300)]
    texts += [texts[0], texts[1] + " more"]
    write(spark, str(tmp_path), [(k, t, "en", "s", 1) for k, t in enumerate(texts)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(texts[2].split()[5:20]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before, threshold = stored(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, gone in (("ngram_jaccard", {300, 301}), ("decontamination", {2})):
            kept = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
            assert {r["doc_id"] for r in kept.collect()} == set(range(302)) - gone
            plan = kept._jdf.queryExecution().optimizedPlan().toString()
            assert "Union" in plan and "strategy=broadcast" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    left = stored(spark)
    for label in before:
        left.remove(label)
    assert not {"sets", "postings", "tokens", "pairs", "open", "classes", "span-hits", "test-spans"} & set(left)


def test_sifted_parts(spark):
    df = spark.createDataFrame([(k if k else None, k % 3 == 0) for k in range(5000)], "id long, may boolean")
    keys = spark.createDataFrame([(None,), (9,), (10,), (4998,)], "key long")
    for among, want in ((None, {None, 9, 10, 4998}), (df["may"], {None, 9, 4998})):
        clear, doubtful = sifted(df, [df["id"]], keys, among)
        clear, doubtful = [r["id"] for r in clear.collect()], [r["id"] for r in doubtful.collect()]
        assert len(clear) + len(doubtful) == 5000 and want <= set(doubtful) and len(doubtful) < 100


def test_large_sets_are_bounded_before_their_tokens_move(spark):
    """Sets of 500 to 2 300 shingles, either side of every size of parity bits: near pairs link, unlike ones are told apart early."""
    rng = random.Random(23)
    words = ["y%d" % k for k in range(5000)]
    texts = []
    for size in (500, 516, 900, 1010, 1020, 1030, 2040, 2060):
        origin = rng.choices(words, k=size)
        for part in (0.05, 0.12, 0.2, 0.24, 0.3):
            texts.append(origin + rng.choices(words, k=int(size * part)))
        texts.append(origin[: size // 2] + rng.choices(words, k=size // 2))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    linked = {
        (a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    pairs = spark.createDataFrame([(a, b) for b in range(len(sets)) for a in range(b)], "a long, b long")
    tokens = jaccard._sets_of(docs, pairs, 5)
    assert {(r["a"], r["b"]) for r in jaccard._verified(pairs, tokens, 80).collect()} == linked
    unlike = {(r["a"], r["b"]) for r in jaccard._unlike(pairs, tokens, 80).collect()}
    large = {(a, b) for a, b in set(map(tuple, pairs.collect())) - linked if min(len(sets[a]), len(sets[b])) > jaccard.BITS}
    assert not unlike & linked and len(unlike) >= 0.95 * len(large)
