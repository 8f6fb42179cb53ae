"""Source divergence, HTML extraction and periodic runs against brute force, with nulls, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import divergence, html_text, periodic_runs
from cadenza.llm import words as W

EXTRA = "lang2 string, key long, hash long, row string, no string, docs string, host string, content string, text2 string"
LOWER = {i: i + 32 for i in range(65, 91)}


def with_extra(df):
    """Extra columns with names that the operators use inside."""
    return df.withColumns({c.split()[0]: F.lit("x").cast(c.split()[1]) for c in EXTRA.split(", ")} | {"runs": F.lit(1), "template": F.lit("t")})


# ---- source divergence ---------------------------------------------------------------

def brute_divergence(rows, min_docs, top):
    docs = [((la or ""), (so or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for t, la, so in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for _, s, w in own:
            counts[s].update(x for x in w if x in set(kept))
        whole = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = share(whole)
        p = {s: share(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            terms = [(-(p[s][t] - q[t]), t.encode()) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(found, 1)}
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    v = ["".join(r.choice("abcdefghé日") for _ in range(r.randint(1, 14))) for _ in range(150)]
    v += [v[3] + x for x in "abcxyz"] + ["ABC", "abc", "Éa", "éa"]
    rows = []
    for i in range(260):
        w = r.choices(v, weights=[1 / (j + 1) for j in range(len(v))], k=r.choice([0, 1, 5, 40, 120]))
        rows.append((r.choice([" ", "1", "-\n"]).join(w), r.choice(["en", "de", None, "", "lonely"]) if i else "single", r.choice(["a", "b", None, "", "c"])))
    rows += [(None, None, None), ("", "nothing", "x"), ("", "nothing", "y"), rows[5], rows[5], ("é " * 20_000 + "abc" * 5000, "en", "long")]
    return rows


@pytest.mark.parametrize("levels,min_docs,tile", [((4, 9), 30, (256, 256)), ((1, 2, 3), 3, (2, 7)), ((2,), 1, (1, 1))])
def test_divergence(spark, texts, levels, min_docs, tile):
    df = with_extra(spark.createDataFrame(texts, "text string, lang string, source string").repartition(4))
    got = [tuple(r) for r in divergence.divergence(df, min_docs, 20, levels, tile).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_divergence(texts, min_docs, 20)


def test_divergence_empty(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.divergence(df).count() == 0


def test_divergence_bitmap_loses_no_frequent_prefix(spark, texts):
    docs = spark.createDataFrame([((t or ""), (la or ""), "") for t, la, _ in texts], "text string, lang string, source string")
    counts = divergence.prefix_documents(docs, 3, None, None)
    want = Counter()
    for t, la, _ in texts:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        want.update({((la or ""), x.encode()[:3]) for x in terms})
    assert sorted(r["docs"] for r in counts.collect()) == sorted(want.values())
    bits = divergence.survivors(counts, 30)
    kept = np.array([r["key"] for r in counts.filter("docs >= 30").collect()], np.int64).view(np.uint64)
    assert len(kept) and divergence._passes(bits, kept).all()
    assert int(np.unpackbits(bits).sum()) <= len(kept)


# ---- HTML extraction ----------------------------------------------------------------------

def main_text(html):
    return "\n".join(html_text.main_blocks(html_text.parse(html), set()))


@pytest.mark.parametrize("html,want", [
    ("", ""),
    ("plain &amp text &copy; &am", "plain & text © &am"),
    ("<html><head><title>T</title></head><body><nav>menu</nav><article><h1>A  b</h1><p>one<br>two<p>th<b>r</b>ee</article><footer>f</footer>", "A b\none two\nthree"),
    ('<script>var t="</p><article>no</article>";</script><style>p{}</style><!-- <p>no</p> --><article><p>1 < 2 &lt;b&gt;</p></article>', "1 < 2 <b>"),
    ("<article><header class=h><h1>Title</h1><span>by me</span></header><p>x</p><aside>no</aside><form>no<input></form><p>y</p></article>", "Title\nx\ny"),
    ("<article><p>x</p><section id='comments'><article class='comment'><p>no</p></article></section></article>", "x"),
    ('<main><div class="cookie-banner">no</div><p>a</p></main><p>out</p>', "a"),
    ('<div class="page with-sidebar"><div class="sidebar">no</div><article>yes</article></div>', "yes"),
    ("<p>a<div>b</div>c", "a\nb\nc"),
    ("<ul><li>one<li>two</ul>", "one\ntwo"),
    ('<ul><li><a href="/1">Home</a></li><li><a href="/2">News</a></li><li><a href="/3">Team</a></li></ul><p>text</p>', "text"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ('<article><p title="a > b">q</p><p hidden>no</p><p style="display: none">no</p></article>', "q"),
    ("<p>a &lt;script&gt; b</p><p>cut <a href='", "a <script> b\ncut"),
    ("<article></article><p>rest</p>", "rest"),
])
def test_main_blocks(html, want):
    assert main_text(html) == want


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "<p>in</p>" + "</div>" * 5000 + "<p>out</p>") == "in\nout"
    long = "word " * 400_000
    assert main_text(f"<nav>x</nav><article><p>{long}</article>") == long.strip()
    assert html_text.subtrees(html_text.parse("<div>" * 3000 + "x"))[0]


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_extracted(spark, broadcast):
    """A host's menu and notice without telling names go; sentences that articles share, and copied articles, stay."""
    r = random.Random(4)
    words = ["w%d" % i for i in range(300)]
    rows, want = [], {}
    copied = "<p>" + " ".join(r.choices(words, k=50)) + "</p><p>Shared sentence of all.</p>"
    for i in range(60):
        shared = "<p>Shared sentence of all.</p>" if i % 5 == 0 else ""
        body = copied if i % 3 == 0 else f"<p>{' '.join(r.choices(words, k=r.randint(20, 60)))}</p>{shared}<p>No {i % 2}.</p>"
        menu = f"<div class='x1'><div>Start</div><div>About {i % 4}</div></div>"
        wrap = "<div class='q'>Please stay tuned to this channel.</div>"
        rows.append((i, "http://Big.example.com/a?b" if i % 2 else "http://big.example.com#z", f"<body>{menu}<div class='c{i % 2}'>{body}</div>{wrap}</body>"))
        want[i] = re.sub(r"</?p>", "\n", body).replace("\n\n", "\n").strip()
    assert len({x[2] for x in rows}) > 40
    rows += [(100, None, None), (101, "no scheme", ""), (102, "http://small.example.com/", "<div class='x1'><div>Start</div></div><p>t</p>"), rows[4], rows[4]]
    want |= {100: "", 101: "", 102: "Start\nt"}
    df = with_extra(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5))
    got = html_text.extracted(df, ["page_id", "template"], broadcast).collect()
    assert len(got) == len(rows)
    assert {x["page_id"]: x["text"] for x in got} == want
    assert all(x["n_template"] >= 2 for x in got if x["page_id"] < 60) and {x["template"] for x in got} == {"t"}
    assert html_text.extracted(df.limit(0)).count() == 0


# ---- periodic runs ---------------------------------------------------------------------------

def brute_runs(x):
    out = []
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                part = x[i: j + q]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i, len(part), q))
            i = j + 1
    return sorted(out, key=lambda t: (t[0], t[2]))


def brute_collapse(x, runs):
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    return " ".join(w for i, w in enumerate(x) if i not in gone)


def periodic_words(r, n, k):
    x = []
    while len(x) < n:
        if r.random() < 0.6:
            b = ["a%d" % r.randrange(k) for _ in range(r.randrange(1, r.choice([8, 30, 200])))]
            x += (b * r.randrange(1, 9))[: r.randrange(1, 500)]
        else:
            x += ["a%d" % r.randrange(k * 10) for _ in range(r.randrange(1, 12))]
    return x[:n]


@pytest.mark.parametrize("tile", [8, 32])
def test_tiles_find_every_run(tile, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TILE", tile)
    r = random.Random(tile)
    for _ in range(250):
        x = periodic_words(r, r.choice([5, 12, 13, 40, 200, 700]), r.choice([1, 2, 3, 12]))
        ids = W.mix(np.unique(x, return_inverse=True)[1].astype(np.uint64) + np.uint64(9))
        place, distance = periodic_runs.repeats(W.ngrams(ids, 6), np.zeros(max(0, len(x) - 5), np.int64))
        spans = defaultdict(list)
        for stride, low, high, reach, first, at, code in periodic_runs.tiles(ids, place, distance):
            for q, found in periodic_runs.solve(code.tolist(), at, first, first + tile * stride, stride, low, high, reach).items():
                spans[q] += found
        got = []
        for q, found in spans.items():
            joined = []
            for s, e in sorted(found):
                if joined and s <= joined[-1][1] - q:
                    joined[-1][1] = max(joined[-1][1], e)
                else:
                    joined.append([s, e])
            got += [(s, e - s, q) for s, e in joined if e - s >= max(12, 2 * q)]
        assert sorted(got, key=lambda t: (t[0], t[2])) == brute_runs(x)


def test_periodic_runs(spark):
    r = random.Random(8)
    texts = [" \t\n".join(periodic_words(r, r.choice([3, 30, 150, 600]), r.choice([2, 20]))) for _ in range(60)]
    texts += [" ".join("u%d" % r.randrange(10**6) for _ in range(200)), None, "", " \n ", "a", " ".join(["x"] * 11), " ".join(["x"] * 12),
              " ".join(["p", "q"] * 6), " ".join(["X", "x"] * 6000), " ".join("v%d" % (i % 997) for i in range(9000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, texts[5]), (None, None)]
    df = with_extra(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))

    def key(d, n, runs, text):
        return (d, n, tuple(runs), text, hashlib.sha256(text.encode()).hexdigest())

    for rewrite in (None, periodic_runs.planted):
        want = Counter()
        for d, t in rows:
            x = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            h = zlib.crc32(str(d).encode())
            if rewrite and d is not None and x and h % 10 == 0:
                a, g = h // 10 % len(x), h // 10
                p = 1 + (len(x) - a) // (3 + g % 8)
                x = [x[i] if i < a else x[a + (i - a) % p] for i in range(len(x))]
            found = brute_runs(x) if len(x) < 2000 else [(0, len(x), {12000: 2, 9000: 997}[len(x)])]
            want[key(d, len(x), found, brute_collapse(x, found))] += 1
        out = periodic_runs.periodic_runs(df, rewrite).collect()
        if rewrite is None:
            got = Counter(key(x["doc_id"], x["n_words"], [tuple(v) for v in x["runs"]], x["collapsed"]) for x in out)
            assert got == want
        else:  # long texts may be rewritten themselves
            got = Counter(key(x["doc_id"], x["n_words"], [tuple(v) for v in x["runs"]], x["collapsed"]) for x in out if x["n_words"] < 2000)
            assert got == Counter({k: v for k, v in want.items() if k[1] < 2000})
        assert all(x["collapsed_sha256"] == hashlib.sha256(x["collapsed"].encode()).hexdigest() for x in out)
    short = periodic_runs.periodic_runs(df, with_text=False).collect()
    assert Counter(x["collapsed_sha256"] for x in short) == Counter(x["collapsed_sha256"] for x in periodic_runs.periodic_runs(df).collect())
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0
