"""The corpus pipeline against a brute-force version, stage by stage."""

import re
from collections import Counter

import corpus_pipeline as P
from cadenza.llm import language, packing

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def _shingles(text):
    w = _words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def _alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({i: i + 32 for i in range(65, 91)}))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "x", 0), (9003, "12 34", None, None, 5)], docs.schema)
    docs = docs.unionByName(extra)
    results = []
    for i, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < 4:
            assert docs.columns == COLUMNS
        results.append(docs)
    ids = [Counter(r["doc_id"] for r in d.select("doc_id").collect()) for d in results[:4]]
    assert not {9001, 9002, 9003} & set(ids[0]) and max(ids[0].values()) == 1
    # near duplicates: no two kept documents are linked, every dropped one has a kept one in its component
    before = {r["doc_id"]: _shingles(r["text"]) for r in results[0].collect()}
    names = sorted(before)
    near = {a: {b for b in names if 100 * len(before[a] & before[b]) >= 75 * len(before[a] | before[b])} for a in names}
    comp, kept = {}, set()
    for a in names:
        if a not in comp:
            kept.add(a)
            todo = [a]
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp[x] = a
                    todo += near[x]
    assert set(ids[1]) == kept
    # contaminated ones go
    items = [_alnum(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {}
    for q in items:
        n = min(13, len(q))
        windows.setdefault(n, set()).update(tuple(q[i:i + n]) for i in range(len(q) - n + 1))
    clean = set()
    for r in results[1].collect():
        w, hit = _alnum(r["text"]), set()
        for n, known in windows.items():
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in known:
                    hit.update(range(p, p + n))
        if not (hit and 20 * len(hit) >= len(w)):
            clean.add(r["doc_id"])
    assert set(ids[2]) == clean
    # the mix has as many words as its input, but for the floors of the budgets
    total = sum(len(_words(r["text"])) for r in results[2].collect())
    mixed = results[3].collect()
    assert abs(sum(len(_words(r["text"])) for r in mixed) - total) <= results[2].select("source").distinct().count()
    whole = {r["doc_id"]: r["text"] for r in results[2].collect()}
    assert all(whole[r["doc_id"]].startswith(r["text"]) for r in mixed)
    # the matrices hold every mixed text
    import tiktoken

    enc = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=packing.read_ranks(packing.TOKENIZER), special_tokens={})
    parts = {}
    for s in packing.segments(results[4]).collect():
        parts.setdefault((s["doc_id"], s["doc_row"]), []).append((s["start"], s["ids"]))
    got = Counter((d, enc.decode([i for _, p in sorted(x) for i in p][:-1])) for (d, _), x in parts.items())
    assert got == Counter((r["doc_id"], r["text"]) for r in mixed if r["text"])


def test_dedup_stage_null_and_repeated_ids(spark):
    def text(name, n=30):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (None, text("c") + " tail"),  # no ids: a, b and one of c stay
            (5, text("d")), (5, text("e")), (9, text("e") + " tail"),  # one id, unlike texts: both stay, 9 is near the second
            (7, text("f")), (None, text("f")), (7, text("f")), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = [(r["doc_id"], r["text"]) for r in P.dedup_stage(spark, docs, SF).collect()]
    c = [x for x in got if x[1] and x[1].startswith("c0 ")]
    assert len(c) == 1 and c[0] in rows
    rest = Counter(x for x in got if x not in c)
    assert rest == Counter([(None, text("a")), (None, text("b")), (5, text("d")), (5, text("e")), (7, text("f")), (None, None), (None, "")])


def test_run_and_empty_input(spark, tmp_path):
    assert P.run(spark, SF).count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for i, (_, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", language.held_out())
    model = language.fit(docs.filter("not held_out"))
    got = language.predict(docs.filter("held_out"), model, ["doc_id", "lang"]).filter("lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)


CLASHING = ["score", "lang_pred", "n_words", "runs", "items", "n_hit", "_id", "_none", "_text_key", "none", "id", "key", "rest", "root", "_text",
            "text_key", "copies", "size", "epoch", "k"]


def test_stages_with_clashing_columns(spark):
    """Columns with names that the stages use inside keep their values, and decide nothing."""
    from pyspark.sql import functions as F
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    docs = plain.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING}).withColumn("n_hit", F.lit(10**6))
    for name, stage in P.STAGES[:4]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        rows = got.select("doc_id", "n_hit", *[c for c in CLASHING if c != "n_hit"]).collect()
        assert rows and all(x["n_hit"] == 10**6 and all(x[c] == f"{c}{x['doc_id']}" for c in CLASHING if c != "n_hit") for x in rows), name
        assert Counter(x["doc_id"] for x in rows) == Counter(x["doc_id"] for x in stage(spark, plain, SF).select("doc_id").collect()), name


def test_stages_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0
