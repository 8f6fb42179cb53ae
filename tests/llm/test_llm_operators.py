"""The training-data operators against brute force, on small tables with nulls, ties, repeats and empty texts."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import chat, decontaminate, fingerprints, language, licenses, line_dedup, mixing, packing, url_rules
from cadenza.llm.components import components
from cadenza.llm.jaccard_join import jaccard_components, join_sets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, size string"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def vocabulary(seed, n=400):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randint(1, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Texts: random, near copies at many distances, exact copies, shared passages, empty, null and very long."""
    r, v = random.Random(5), vocabulary(1)
    base = [" ".join(r.choices(v, k=r.choice([1, 3, 4, 5, 6, 40, 90, 200]))) for _ in range(40)]
    texts = list(base)
    for t in base[::2]:
        for edits in (0, 1, 2, 5):
            w = t.split(" ")
            for _ in range(edits):
                w[r.randrange(len(w))] = r.choice(v)
            texts.append(" ".join(w))
    shared = " ".join(r.choices(v, k=60))
    texts += [t + "\n" + shared + "\n" + base[i] for i, t in enumerate(base[:15])]
    texts += [None, "", "  \n\t ", None, "", "Zz", "zZ", "¡¿!", " ".join(r.choices(v, k=30_000))]
    sources = ["b", "a", None, "c", "b"]
    rows = [(i, t, ["en", "de", None][i % 3], sources[i % 5], 0 if t is None else len(t), "x", "y") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base[4], None, "a", None, None, None), (None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ---- components, Jaccard join ------------------------------------------------------

def roots(n, edges):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(70)] + [(300, 300), (301, 300)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges + [(None, 5)], "a long, b long")).collect()}
    want = roots(400, edges)
    for a, b in edges:
        if a != b:
            assert got[a] == want[a] and got[b] == want[b]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    edges = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    comp = roots(len(rows), edges)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if comp[j] == comp[i] and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if sets[i] and ids else (None if sets[i] else d)))
    return Counter(out)


@pytest.mark.parametrize("small_block,tile", [(32, 384), (2, 3)])
def test_jaccard_components(docs, corpus, small_block, tile):
    got = jaccard_components(docs, small_block=small_block, tile=tile)
    want = brute_components([(r[0], r[1]) for r in corpus])
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == want


def test_jaccard_empty(none):
    assert jaccard_components(none).count() == 0


def test_join_sets_threshold():
    r = random.Random(3)
    base = np.array(sorted(r.sample(range(1 << 62), 700)), np.uint64)
    sets = [np.unique(np.concatenate([base[r.randrange(0, 120):], np.array(r.sample(range(1 << 62), r.randrange(0, 150)), np.uint64)])) for _ in range(90)]
    edges = [(i, j) for i, j in itertools.combinations(range(90), 2)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
    assert roots(90, join_sets(sets)) == roots(90, edges)


# ---- decontamination ---------------------------------------------------------------

def brute_hits(text, items):
    w, hit, found = alnum(text), set(), set()
    for item_id, t in items:
        q = alnum(t)
        n = min(13, len(q))
        windows = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if n else set()
        for p in range(len(w) - n + 1 if n else 0):
            if tuple(w[p:p + n]) in windows:
                hit.update(range(p, p + n))
                found.add(str(item_id))
    return len(w), len(hit), sorted(found)


@pytest.fixture(scope="module")
def bench(corpus):
    r, v = random.Random(9), vocabulary(1)
    texts = [t for t in (c[1] for c in corpus) if t and len(t.split()) > 30]
    items = [(i, " ".join(t.split()[3:3 + n])) for i, (t, n) in enumerate(zip(texts, itertools.cycle([13, 14, 25, 12, 5, 2, 40])))]
    return items + [(900, None), (901, "?!"), (902, " ".join(r.choices(v, k=50))), (900, items[0][1]), (None, items[1][1])]


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_contamination(spark, docs, corpus, bench, block_bytes):
    found = decontaminate.contamination(docs, spark.createDataFrame(bench, "item_id long, text string"), block_bytes=block_bytes)
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in found.withColumn("n_hit", decontaminate.hit_words()).collect())
    want = Counter()
    for c in corpus:
        n, h, f = brute_hits(c[1], bench)
        want[c[0], n, h, ",".join(x for x in f if x != "None")] += 1
    assert got == want


def test_contamination_empty(spark, docs, none, bench):
    items = spark.createDataFrame(bench, "item_id long, text string")
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("size(runs) > 0").count() == 0


def test_winnowing_keeps_one_in_every_window():
    h = np.array([random.Random(1).randrange(1 << 60) for _ in range(500)] * 2, np.uint64)
    at = set(decontaminate.kept(h, np.ones(len(h), bool), 8).tolist())
    assert all(at & set(range(i, i + 8)) for i in range(len(h) - 7))


# ---- mixing ------------------------------------------------------------------------

def test_mixing(spark, docs, corpus, none):
    rows = mixing.taken(docs).collect()
    assert len(rows) == len(corpus)
    sizes, taken, target = Counter(), Counter(), {}
    for x in rows:
        assert 0 <= x["taken"] <= 3 * x["size"]
        sizes[x["source"]] += x["size"]
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
        assert x["source_size"] >= x["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    assert dict(sizes) == {s: sum(len(words(c[1])) for c in corpus if c[3] == s) for s in order}
    # shares by weight, the excess over three times a size handed on until none is above
    want, open_, left = {}, set(order), sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
            open_.remove(s)
    for s in order:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 4  # floors; equal rows share a cut evenly
    again = mixing.taken(docs.repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert mixing.taken(none).count() == 0


def test_mixed_rows_hold_the_words_taken(docs):
    want = Counter()
    for x in mixing.taken(docs).collect():
        want[x["source"]] += x["taken"]
    got = Counter()
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    for x in out.collect():
        got[x["source"]] += len(words(x["text"]))
        assert x["n_chars"] is None or x["text"] is None or x["n_chars"] == len(x["text"])
    assert got == want


# ---- packing -----------------------------------------------------------------------

def test_segment_tree_and_best_fit():
    r = random.Random(4)
    lengths = np.array([r.randint(1, 64) for _ in range(400)])
    rows = packing.best_fit_decreasing(lengths, 64)
    assert sorted(i for row in rows for i in row) == list(range(400))
    assert all(sum(lengths[i] for i in row) <= 64 for row in rows)
    # the same by trying every row
    bins = []
    for n in sorted(lengths.tolist(), reverse=True):
        fit = [b for b in bins if b[0] >= n]
        if fit:
            b = min(fit, key=lambda b: b[0])
            b[0] -= n
            b.append(n)
        else:
            bins.append([64 - n, n])
    assert Counter(64 - b[0] for b in bins) == Counter(int(sum(lengths[i] for i in row)) for row in rows)


def test_packing_round_trip(docs, corpus, none):
    import tiktoken

    ranks = packing.read_ranks(packing.TOKENIZER)
    enc = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    matrices = packing.packed(docs, seq_len=256, matrix_rows=7, batch_ids=20_000)
    for m in matrices.collect():
        pos = np.frombuffer(bytes(m["position_ids"]), "<u2").reshape(m["n_rows"], 256)
        at = 0
        for r, n in enumerate(m["row_segments"]):
            cu = m["cu_seqlens"][at + r: at + r + n + 1]
            assert cu[0] == 0 and cu[-1] <= 256
            for a, z in itertools.pairwise(cu):
                assert pos[r, a:z].tolist() == list(range(z - a))
            at += n
    pieces = {}
    for s in packing.segments(matrices).collect():
        pieces.setdefault((s["doc_id"], s["doc_row"]), []).append((s["start"], s["ids"]))
    got = Counter()
    for (d, _), parts in pieces.items():
        ids = [i for _, p in sorted(parts) for i in p]
        assert ids[-1] == packing.END_OF_TEXT
        got[d, enc.decode(ids[:-1])] += 1
        assert ids[:-1] == enc.encode_ordinary(enc.decode(ids[:-1]))
    assert got == Counter((c[0], c[1]) for c in corpus if c[1])
    assert packing.packed(none).count() == 0


def test_encoder_cuts_as_the_tokenizer_does():
    import pyarrow as pa
    import tiktoken

    from cadenza.llm import words as W

    ranks = packing.read_ranks(packing.TOKENIZER)
    enc = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(8)
    parts = ["a", " ", "  ", " ", " ", "　", "\u0085", "\x1f", "\n", "\t ", "é", "'s", "12", "日本", "..", "😀", "don't", " x"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 25))) for _ in range(3000)]
    for _, _, buf, off in W.text_blocks(pa.array(texts)):
        ids, bounds = packing.Encoder(ranks).encode(buf, off)
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == enc.encode_ordinary(t), repr(t)


# ---- language ----------------------------------------------------------------------

def test_language(spark):
    r = random.Random(6)
    kinds = {"aa": "abcde", "bb": "cdefg", "cc": "ghiüö"}
    rows = []
    for i in range(300):
        lang = r.choice(list(kinds))
        text = " ".join("".join(r.choices(kinds[lang], k=r.randint(2, 7))) for _ in range(r.randint(5, 60)))
        rows.append((i, text.upper() if i % 7 == 0 else text, lang))
    extra = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !?", "bb"), (1003, "日本語", None), (None, rows[0][1], None), rows[5]]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").repartition(3)
    model = language.fit(df.filter(~language.held_out()))
    assert set(model.languages) == set(kinds)
    got = language.predict(df, model, ["doc_id", "lang"]).collect()
    assert len(got) == len(rows) + len(extra)
    by = {x["doc_id"]: x for x in got}
    assert np.mean([by[i]["lang_pred"] == lang for i, _, lang in rows]) > 0.97
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert by[1003]["lang_pred"] in kinds and by[1003]["score"] == 0
    assert all(0 <= x["score"] <= 1 for x in got)
    nothing = language.fit(df.limit(0))
    assert {x["lang_pred"] for x in language.predict(df, nothing, ["doc_id"]).collect()} == {"und"}


def test_trigram_bounds():
    import pyarrow as pa

    from cadenza.llm import words as W

    texts = ["ab", "", "1", None, "É x", "--ab--cd--", "abc"]
    for _, _, buf, off in W.text_blocks(pa.array(texts)):
        codes, bounds = language.trigrams(buf, off)
        assert np.diff(bounds).tolist() == [2, 0, 0, 0, 2, 4, 3]


# ---- fingerprints ------------------------------------------------------------------

def test_fingerprints(docs, corpus, none):
    got = fingerprints.with_neighbours(docs).collect()
    assert len(got) == len(corpus)
    order = sorted((c for c in corpus if c[0] is not None), key=lambda c: -c[0])
    text = {}
    for c in order:
        text.setdefault(c[0], c[1] or "")
    by_text = {}
    for x in got:
        if x["doc_id"] is None:
            continue
        t = text[x["doc_id"]]
        assert x["n_chars"] == len(t)
        by_text.setdefault(t, set()).add(x["fingerprint"])
        if x["doc_id"] not in (3, 4, 0):
            nxt = text[x["doc_id"] - 1]
            h = len(t) // 2
            assert x["edited_sha256"] == hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest()
            if t == nxt:
                assert x["near_next"] == 1.0
    assert all(len(p) == 1 for p in by_text.values())
    assert fingerprints.with_neighbours(none).count() == 0


def test_collision_rate_is_generalised_jaccard(spark):
    r = random.Random(11)
    a = {f"t{i}": r.randint(1, 6) for i in range(60)}
    b = {f"t{i}": r.randint(1, 6) for i in range(25, 90)}
    rows = [(d, t) for d, m in ((0, a), (1, b)) for t, n in m.items() for _ in range(n)]
    terms = spark.createDataFrame(rows, "d long, w string").select("d", F.xxhash64("w").alias("term"))
    p = {x["d"]: x["fingerprint"] for x in fingerprints.fingerprints(terms, ["d"], 160).collect()}
    same = np.mean([p[0][8 * k:8 * k + 8] == p[1][8 * k:8 * k + 8] for k in range(160)])
    want = sum(min(a.get(t, 0), b.get(t, 0)) for t in a | b) / sum(max(a.get(t, 0), b.get(t, 0)) for t in a | b)
    assert abs(same - want) < 4 * math.sqrt(want * (1 - want) / 160)


def test_error_at_the_registered_samples(spark):
    r = random.Random(12)
    rows, want = [], []
    for p in range(120):  # pairs with words of their own, so that errors are independent
        a, b = ({f"{p} {i}": r.randint(1, 4) for i in range(*span)} for span in ((0, 60), (25, 85)))
        rows += [(2 * p + side, t) for side, m in enumerate((a, b)) for t, n in m.items() for _ in range(n)]
        want.append(sum(min(a.get(t, 0), b.get(t, 0)) for t in a | b) / sum(max(a.get(t, 0), b.get(t, 0)) for t in a | b))
    terms = spark.createDataFrame(rows, "d long, w string").select("d", F.xxhash64("w").alias("term"))
    prints = fingerprints.fingerprints(terms, ["d"])
    left = prints.filter("d % 2 = 0").select((F.col("d") / 2).cast("int").alias("p"), F.col("fingerprint").alias("x"))
    right = prints.filter("d % 2 = 1").select(((F.col("d") - 1) / 2).cast("int").alias("p"), F.col("fingerprint").alias("y"))
    got = left.join(right, "p").select("p", fingerprints.likeness(F.col("x"), F.col("y")).alias("j")).collect()
    errors = np.array([g["j"] - want[g["p"]] for g in got])
    assert len(errors) == 120 and abs(errors.mean()) < 0.02
    assert np.sqrt((errors ** 2).mean()) < 0.068  # sqrt(J (1 - J) / 64) is about 0.057 here, with 32 samples 0.08


# ---- lines -------------------------------------------------------------------------

def sentence_units(text):
    """``(start, end, words)``: units end at a line end or after a word that ends in .!?, and reach to the next one."""
    out, at = [], 0
    for line in text.split("\n"):
        own = []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", line):
            if not own:
                out.append([at + m.start(), None, own])
            own.append(m[0].translate(LOWER))
            if m[0][-1] in ".!?":
                own = []
        at += len(line) + 1
    for u, v in itertools.pairwise([*out, [len(text)]]):
        u[1] = v[0]
    return out


def brute_dedup(rows, least):
    def place(d):
        return (d[0] is None, d[0] or 0, line_key[d[1]])

    known = defaultdict(list)
    for d in set(rows):
        u = [tuple(x[2]) for x in sentence_units(d[1] or "")]
        for k in [*itertools.pairwise(u), *[(x,) for x in u if len(x) >= least]]:
            known[k].append(place(d))
    first = {k: min(v) for k, v in known.items()}
    want = Counter()
    for d in rows:
        if d[1] is None:
            want[d[0], None, ()] += 1
            continue
        u = sentence_units(d[1])
        held = [False] * len(u)
        tied = [False] * len(u)
        for i, x in enumerate(u):
            if len(x[2]) >= least and first[tuple(x[2]),] < place(d):
                held[i] = True
            if i + 1 < len(u) and first[tuple(x[2]), tuple(u[i + 1][2])] < place(d):
                held[i] = held[i + 1] = tied[i] = True
        gone, i = [], 0
        while i < len(u):
            j = i
            while held[i] and tied[j]:
                j += 1
            if held[i] and sum(len(x[2]) for x in u[i:j + 1]) >= least:
                gone.append((u[i][0], u[j][1]))
            i = j + 1
        text = "".join(d[1][a:b] for a, b in zip([0, *[g[1] for g in gone]], [*[g[0] for g in gone], len(d[1])]))
        want[d[0], text, tuple(gone)] += 1
    return want


line_key = {}


@pytest.mark.parametrize("least", [40, 6])
def test_line_dedup(spark, docs, corpus, none, least):
    r, v = random.Random(21), vocabulary(9, 60)

    def prose(n):
        return " ".join(r.choice(v) + r.choice(["", "", "", "", ".", "!", ". ", "\n", " \n\t"]) for _ in range(n))

    shared = [prose(r.choice([3, 12, 45, 60, 200])) for _ in range(12)]
    made = []
    for i in range(120):
        parts = [r.choice([r.choice(shared), prose(r.randint(1, 40)), shared[0].upper()]) for _ in range(r.randint(1, 6))]
        made.append((i // 2 if i % 7 else None, r.choice([" ", "\n", ". "]).join(parts)))
    made += [(500, "word. " * 40_000), (501, "word. " * 40_000), (502, "  "), (503, "é " * 50 + "."), (504, "é  " * 50 + ".")]
    rows = [(c[0], c[1]) for c in corpus] + made + [made[3], made[3]]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(made + [made[3], made[3]], "doc_id long, text string")).repartition(5)
    df = df.withColumns({x: F.lit("x") for x in ("held", "d1", "at", "_id", "removed", "digests")})
    line_key.update({x["text"]: x["k"] for x in df.select("text", F.when(F.col("text").isNull(), 0).otherwise(F.xxhash64("text")).alias("k")).collect()})
    got = Counter((x["doc_id"], x["text"], tuple((s["start"], s["end"]) for s in x["removed"])) for x in line_dedup.deduplicated(df, least).collect())
    assert got == brute_dedup(rows, least)
    assert any(k[2] for k in got)
    assert line_dedup.deduplicated(none).count() == 0


# ---- licences ----------------------------------------------------------------------

def test_license_scan(spark, none):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    rows = [(1, "some words here\nReleased under the MIT license\nmore words"), (2, "x " * 50 + mit.upper().replace(",", ";\n") + " y" * 40),
            (3, None), (4, ""), (5, "the of and under the"), (6, "Licensed under CC BY-NC 4.0."), (7, "Licensed under the Apache License, Version 2.0."), (7, "Licensed under the Apache License, Version 2.0.")]
    got = {x["doc_id"]: x for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["license"] for i in (1, 2, 3, 4, 5, 6, 7)] == ["MIT", "MIT", None, None, None, "CC-BY-NC-4.0", "Apache-2.0"]
    assert got[2]["dice"] > 0.97 and got[6]["dice"] == 1.0
    assert licenses.scan(none).count() == 0


def test_license_look_alikes(spark):
    notice = next(t for n, t in licenses.TEMPLATES if n == "GPL-3.0" and t.startswith("This program"))
    lines = {"This work is licensed under the GNU General Public License, version 2.": "GPL-2.0", notice: "GPL-3.0",
             notice.replace("version 3", "version 2"): "GPL-2.0", notice.replace("GNU General", "GNU Lesser General"): "LGPL-3.0",
             notice.replace("GNU General", "GNU Affero General"): "AGPL-3.0",
             "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0", "Licensed under CC BY 3.0.": "CC-BY-3.0",
             "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0", "Licensed under CC0 1.0.": "CC0-1.0"}
    for kind in ("BSD-2-Clause", "BSD-3-Clause"):  # another holder, cut into short lines
        text = max((t for n, t in licenses.TEMPLATES if n == kind), key=len)
        lines["\n".join(re.findall(r".{1,60}(?: |$)", text.replace("copyright holder ", "University ")))] = kind
    for kind, text in licenses.TEXTS.items():
        lines["some words\n" + text.replace(". ", ".\n") + "\nmore words"] = kind
    rows = [(i, t) for i, t in enumerate(lines)]
    got = {x["doc_id"]: x["license"] for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == list(lines.values())


def plain_matches(text, templates, least):
    """The rule without hashes, bounds or an index: every line and every run is compared with its templates."""
    lines, w, line = [], [], []
    for n, part in enumerate((text or "").split("\n")):
        own = alnum(part)
        lines.append((len(w), len(w) + len(own)))
        w += own
        line += [n] * len(own)
    pairs = list(itertools.pairwise(w))
    sets = [set(itertools.pairwise(alnum(t))) for _, t in templates]
    known = set().union(*sets)
    todo = {(a, z): list(range(len(sets))) for a, z in lines if any(p in known for p in pairs[a:z])}
    for i, t in enumerate(sets):
        run = []
        for at in [*[k for k, p in enumerate(pairs) if p in t], None]:
            if run and (at is None or at - run[-1] > licenses.GAP):
                todo.setdefault((run[0], run[-1] + 2), []).append(i)
                run = []
            run.append(at)
    found = []
    for (a, z), among in todo.items():
        own = set(pairs[a:z - 1])
        for i in dict.fromkeys(among):
            d = 2 * len(own & sets[i]) / (len(own) + len(sets[i]))
            if d >= least:
                found.append((i, d, a, z))
    kept = []
    for m in sorted(found, key=lambda m: (-m[1], m[2] - m[3], m[2], m[0])):
        if all(m[3] <= k[2] or m[2] >= k[3] for k in kept):
            kept.append(m)
    return [(templates[i][0], pytest.approx(d), a, z) for i, d, a, z in sorted(kept, key=lambda m: m[2])]


def test_license_scan_equals_the_plain_rule(spark):
    r, v = random.Random(31), [f"w{i}" for i in range(30)]
    templates = [(f"L{i % 7}", " ".join(r.choices(v, k=r.choice([2, 3, 6, 12, 40])))) for i in range(14)]
    rows = []
    for i in range(220):
        parts = []
        for _ in range(r.randint(0, 6)):
            w = alnum(r.choice(templates)[1]) if r.random() < 0.7 else r.choices(v, k=r.randint(1, 12))
            w = [x for x in w if r.random() < 0.93]
            for _ in range(r.choice([0, 0, 1, 3])):
                w.insert(r.randrange(len(w) + 1), r.choice(v).upper())
            parts.append(r.choice([" ", " ", "\n"]).join(w))
        rows.append((i, r.choice([" ", "\n", ". "]).join(parts)))
    rows += [(500, None), (501, ""), (502, " ".join([templates[3][1]] * 3000)), rows[7], rows[7], (None, rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("license", "dice", "matches")})
    for least in (0.8, 0.55):
        got = licenses.scan(df, templates, least).collect()
        assert len(got) == len(rows)
        want = {d: plain_matches(t, templates, least) for d, t in rows}
        for x in got:
            assert [tuple(m) for m in x["matches"]] == want[x["doc_id"]], x["doc_id"]
            assert x["dice"] == max([0.0, *[m["dice"] for m in x["matches"]]])


def test_size_bounds_lose_nothing():
    tp = licenses.Templates(licenses.TEMPLATES, 0.8)
    r = random.Random(2)
    for _ in range(200):
        s = r.choice(tp.sets)
        own = np.unique(np.concatenate([s[: r.randint(1, len(s))], np.array([r.randrange(1 << 60) for _ in range(r.randint(0, 9))], np.uint64)]))
        near = set(tp.candidates(len(own), list(range(len(tp.sets)))))
        assert all(i in near for i, t in enumerate(tp.sets) if licenses.dice(own, t) >= 0.8)


# ---- URLs --------------------------------------------------------------------------

def test_url_rules(spark):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        spam = r.random() < 0.3
        host = r.choice(["win.casino.example.com", "a.example.com"]) if spam else r.choice(["news.example.com", "casino.example.com", "win.example.com"])
        rows.append((i, f"https://{host}/{r.choice(['x', 'y'])}/{i}?q={i % 9}"))
        if i < 400:
            labels.append((i, host.startswith("win.casino")))
    rows += [(1000, None), (1001, "no scheme"), (1002, "http://A.Example.NET/en/x?z"), (1003, "http://example.net#/en/"), (1004, "http://b.de.net/"),
             (1005, "ftp://x.org/fr/1"), (1006, "http://xorg/fr/1"), (1007, "http://example.com/de/a"), rows[0]]
    fixed = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    got = url_rules.judged(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels + [(1, None)], "page_id long, bad boolean"), fixed).collect()
    assert len(got) == len(rows)
    by = {x["page_id"]: x for x in got}
    for i, u in rows[:600]:
        assert by[i]["verdict"] == ("block" if "//win.casino" in u else "allow"), (u, by[i])
    assert by[0]["antecedent"] is None or set(by[0]["antecedent"]) <= {"h:win", "h:casino", "h:example", "h:com", "p:x", "p:y"}
    say = {i: (by[i]["host"], by[i]["path"], by[i]["rule"], by[i]["verdict"]) for i in range(1000, 1008)}
    assert say[1000] == say[1001] == ("", "", None, "allow")
    assert say[1002] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert say[1003] == ("example.net", "", None, "allow")
    assert say[1004] == ("b.de.net", "/", "net/", "block")
    assert say[1005] == ("x.org", "/fr/1", "org/fr/", "allow")
    assert say[1006][2:] == (None, "allow")
    assert say[1007] == ("example.com", "/de/a", "example.com/de/", "block")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judged(empty, spark.createDataFrame([], "page_id long, bad boolean"), fixed).count() == 0


def test_mined_rules_are_all_that_hold(spark):
    r = random.Random(17)
    rows = []
    for _ in range(260):
        t = sorted(x for x in "abcdef" if r.random() < 0.45)
        rows.append((t, None if r.random() < 0.05 else r.random() < (0.9 if {"a", "b"} <= set(t) else 0.75 if "c" in t else 0.2)))
    rows += [([], True), (None, True), rows[0], rows[0]]
    known = [(set(t), b) for t, b in rows if b is not None and t]
    for count, least in ((20, 0.6), (5, 0.5)):
        rules = {}
        for n in range(1, 7):
            for a in itertools.combinations("abcdef", n):
                fits = [b for t, b in known if set(a) <= t]
                if sum(fits) >= max(count, 0.0005 * len(known)) and sum(fits) / len(fits) >= least:
                    rules[a] = sum(fits) / len(fits)
        want = {a: c for a, c in rules.items() if not any(set(s) < set(a) and d >= c for s, d in rules.items())}
        got = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.0005, least, count).collect()
        assert want and {tuple(x["antecedent"]): pytest.approx(x["confidence"]) for x in got} == want


# ---- chat --------------------------------------------------------------------------

def test_turns_round_trip():
    parts = ["\\", "<", ">", '"', "</turn>\n", '<turn role="', "\\l", "\\q", "### Assistant:", "é😀", "\n", "user"]
    r = random.Random(3)
    for _ in range(500):
        turns = [("".join(r.choices(parts, k=r.randint(0, 3))), "".join(r.choices(parts, k=r.randint(0, 9)))) for _ in range(r.randint(0, 4))]
        turns += [("assistant", "a<b\\")]
        text, mask = chat.format_turns(turns)
        assert chat.parse_turns(text) == turns
        assert [chat.unescape(text[a:z]) for a, z in mask] == [t for role, t in turns if role == "assistant"]


def test_reply_trees(spark):
    r = random.Random(12)
    rows, paths = [], {}
    for tree in [*range(25), None]:
        n = r.choice([1, 2, 9, 40])
        up = {0: None} | {i: r.randrange(max(0, i - 3), i) for i in range(1, n)}
        score = {i: r.choice([-1.0, 0.0, 0.5, 2.0]) for i in up}
        rows += [(tree, i, up[i], r.choice(["user", "assistant", None]), r.choice(["t%d" % i, None, "<\\"]), score[i]) for i in up]
        best = []
        for leaf in set(up) - set(up.values()):
            path = [leaf]
            while up[path[-1]] is not None:
                path.append(up[path[-1]])
            best.append((-sum(score[i] for i in path), -len(path), leaf, path[::-1]))
        text = {i: (ro or "", t or "") for tr, i, _, ro, t, _ in rows if tr == tree}
        for b, (_, _, _, path) in enumerate(sorted(best)[:2], 1):
            paths[tree, b] = [text[i] for i in path]
    df = spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, role string, text string, score double")
    got = {(x["tree_id"], x["branch"]): chat.parse_turns(x["formatted"]) for x in chat.transcripts(df, top=2).collect()}
    assert got == paths
    assert chat.transcripts(df.limit(0)).count() == 0


def test_reply_trees_with_cycles_and_repeats(spark):
    path = [(1, 0, None, "user", "a", 0.0), (1, 1, 0, "assistant", "b", 1.0), (1, 2, 1, "user", "c", 0.0)]
    rows = [*path, path[1], path[1], (1, 1, 0, "assistant", "bb", 1.0),  # repeats, and another text for node 1
            (1, 7, 7, "user", "own parent", 9.0), (1, 8, 7, "user", "below it", 9.0),
            (2, 0, 1, "user", "x", 0.0), (2, 1, 2, "user", "y", 0.0), (2, 2, 0, "user", "z", 0.0),  # a cycle only
            (3, 0, 0, "user", "s", 0.0), (3, 1, None, "assistant", "t", 0.0),
            (4, None, None, "user", "no node", 0.0), (None, 0, 5, "user", "no parent", 0.0)]
    df = spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, role string, text string, score double").withColumns(
        {"jump": F.lit(1), "n": F.lit(1), "branch": F.lit("x"), "none": F.lit(1)})
    got = {x["tree_id"]: chat.parse_turns(x["formatted"]) for x in chat.transcripts(df).collect()}
    assert got == {1: [("user", "a"), ("assistant", "b"), ("user", "c")], 3: [("assistant", "t")], None: [("user", "no parent")]}


def test_own_score_of_a_large_alphabet(spark):
    """A language whose trigrams are mostly rare is measured by its own text, not by that of others."""
    r = random.Random(4)
    rows = [("".join(chr(0x4E00 + min(r.randrange(3000), r.randrange(3000))) for _ in range(400)), "zh") for _ in range(60)]
    rows += [(" ".join(r.choices(["the", "and", "of", "house", "tree"], k=80)), "en") for _ in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language.fit(docs, min_rate=2e-5 * 3)
    own = dict(zip(model.languages, model.own, strict=True))
    assert own["en"] > 0.99 and own["zh"] <= 1
    fresh = spark.createDataFrame(rows[:5] + rows[60:65], "text string, lang string")
    for x in language.predict(fresh, model, ["lang"]).collect():
        assert x["lang_pred"] == x["lang"] and x["score"] >= 0.5 * own[x["lang"]]
