"""Language identification, page extraction, top-k and fingerprints."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import fingerprint, html_extract, langid, topk

LANGUAGES = {"xx": "ba be bi bo bu da de di do du".split(), "yy": "kra kro stru stri plo ple zza zzo".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(LANGUAGES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, lang, rng.randint(1, 60)), lang, "rejected") for i in range(240) for lang in [rng.choice(["xx", "yy"])]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_held_out_accuracy_and_edge_cases(spark, labelled):
    rows = labelled.withColumn("out", langid.held_out())
    model = langid.fit(rows.where("NOT out"))
    got = langid.predict(rows, model)
    tested = got.where("out")
    assert tested.count() > 30 and tested.where("lang_pred = lang").count() >= 0.95 * tested.count()
    assert got.where("score < 0 or score > 1 or rejected").count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 --"), (4, "中文文本"), (5, "BA be " * 400_000)], "id long, text string")
    found = {r.id: r for r in langid.predict(odd, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(found[i].rejected for i in (1, 2, 3, 4))
    assert found[5].lang_pred == "xx" and found[4].lang_pred in ("xx", "yy")


def test_far_texts_are_rejected_at_every_length(spark, labelled):
    """Unlearned scripts and letter noise go, however long; all clean texts stay, also short ones."""
    rng = random.Random(11)
    model = langid.fit(labelled)
    alphabets = {"cyrillic": "абвгдежзийклмнопрстуфхцчшщ  ", "greek": "αβγδεζηθικλμνξοπρστυφχψω  ",
                 "han": "".join(chr(0x4E00 + i) for i in range(3000)), "noise": "cfghjmnqtvwxcfghjmnqtvwx    "}
    odd = [(f"{name} {n}", "".join(rng.choice(letters) for _ in range(n)))
           for name, letters in alphabets.items() for n in (20, 200, 2_000, 20_000)]
    clean = [(f"clean {lang} {n} {i}", prose(rng, lang, n)) for lang in LANGUAGES for n in (1, 3, 10, 60, 600) for i in range(20)]
    got = {r.id: r.rejected for r in langid.predict(spark.createDataFrame(odd + clean, "id string, text string"), model).collect()}
    assert [i for i, _ in odd if not got[i]] == [] and [i for i, _ in clean if got[i]] == []


def test_late_letters_and_clashing_columns(spark, labelled):
    model = langid.fit(labelled)
    odd = spark.createDataFrame([(1, "\U00030001\U00030002\U00030003", "kept")], "id long, text string, _near string")
    got = langid.predict(odd, model).first()
    assert got.lang_pred != "und" and got._near == "kept"


def test_no_training_rows_know_no_language(spark, labelled):
    model = langid.fit(labelled.limit(0))
    assert {r.lang_pred for r in langid.predict(labelled.limit(3), model).collect()} == {"und"}
    assert langid.predict(labelled.limit(0), model).count() == 0


def test_grams_do_not_depend_on_the_piece(monkeypatch):
    text = "Ab, cd--ef  gh9ij kl " * 30
    whole = langid.grams(text)
    for piece in (1, 2, 7, 64):
        monkeypatch.setattr(langid, "_PIECE", piece)
        assert all((a == b).all() for a, b in zip(langid.grams(text), whole))


def test_held_out_is_the_checksum_rule(spark):
    import zlib
    got = {r.doc_id: r.h for r in spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", langid.held_out().alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}


PAGE = """<html><head><title>T</title></head><body><header class="site-header"><a href="/">Site</a><nav><a>Home</a></nav></header>
<div class="cookie-banner">We use cookies. <button>OK</button></div><aside><p>Popular posts are here, and many more.</p></aside>
<article><h1>Title &amp; more</h1><p>First   paragraph with <a href="x">a link</a>, and<br>more.</p><ul><li>one</li><li>two</ul>
<div class="ad">Buy now!</div><p>Second&nbsp;one.<p>Third.<form><p>Enter email</p><input></form></article>
<section id="comments"><h2>Comments</h2><div><p>I really liked this, a very good read and long enough to be text.</p></div></section>
<footer>&copy; me</footer><script>var t="<p>no</p>";</script></body></html>"""
TEXT = "Title & more\nFirst paragraph with a link, and more.\none\ntwo\nSecond one.\nThird."


@pytest.fixture(scope="module")
def site(spark):
    rng = random.Random(9)
    rows = []
    for i in range(40):
        body = "".join(f"<p>{prose(rng, 'xx', rng.randint(3, 60))}.</p>" for _ in range(rng.randint(1, 6)))
        rows.append((i, f"http://x/{i}", f"<html><body><nav><ul><li><a>{prose(rng, 'yy', 2)}</a></li></ul></nav><div class='ad'>{prose(rng, 'yy', 5)}</div>"
                     f"<article><h1>{prose(rng, 'xx', 4)}</h1>{body}</article><footer>{prose(rng, 'yy', 6)}</footer></body></html>"))
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_main_text(spark, site):
    model = html_extract.fit(site)
    more = spark.createDataFrame([(100, "u", PAGE), (101, None, None), (102, "u", ""), (103, "u", PAGE)], "page_id long, url string, html string")
    got = {r.page_id: r for r in html_extract.extract(site.unionByName(more), model).collect()}
    assert got[100].text == TEXT == got[103].text and got[100].n_chars == len(TEXT)
    assert got[101].text == got[102].text == "" and got[101].n_chars == 0
    for r in site.collect():
        import re
        article = re.search("<article>(.*)</article>", r.html)[1]
        assert got[r.page_id].text == "\n".join(re.findall(r">([^<]+)</", article))
    assert html_extract.extract(site.limit(0), html_extract.fit(site.limit(0))).count() == 0


@pytest.mark.parametrize("text, blocks", [("<", "<"), ("<a", ""), ("x<y>z", "xz"), ("<p>a<p>b", "a\nb"), ("&lt;b&gt; t", "<b> t"),
                                          ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("a<script>x", "a"), ("a<!-- b -->c<!-- d", "ac"),
                                          ("<div><b>a</div>b</b>", "a\nb"), ("</p>x</div>", "x"), ("a<style>p</style>b", "ab")])
def test_parser(text, blocks):
    page = html_extract.parse(text)
    assert html_extract.block_text(page, [True] * len(page.tags)) == blocks


ARTICLE = ("<article><h1>The history of stone bridges in the valley</h1><p>" + "Bridges were built of stone, and many stand today. " * 6
           + "</p><h2 id='contact-tracing'>Contact tracing of the masons</h2><p>" + "The masons kept long records, which we can read. " * 5
           + "</p><section class='related-work'><h2>Related work</h2><p>" + "Other valleys had bridges of wood, as records show. " * 5 + "</p></section></article>")
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>{name}</a></li>" for i, name in enumerate(["Home", "News", "Sport", "Shop"])) + "</ul>"


@pytest.mark.parametrize("page", [
    "<html><body class='no-sidebar'><nav>MENU</nav>ARTICLE</body></html>", "<html><body><div class='has-banner'><nav>MENU</nav>ARTICLE</div></body></html>",
    "<html><body><form action='/x'><nav>MENU</nav>ARTICLE<footer>c 2020</footer></form></body></html>",
    "<html><body>MENUARTICLE</body></html>", "<html><body><div>MENU</div>ARTICLE<div>MENU</div></body></html>"])
def test_structure_overrules_names(page, trees):
    parsed = html_extract.parse(page.replace("MENU", MENU).replace("ARTICLE", ARTICLE))
    got = html_extract.block_text(parsed, html_extract.decode(parsed.parents, trees.log_odds(html_extract.features(parsed))))
    whole = html_extract.parse(ARTICLE)
    assert got == html_extract.block_text(whole, [True] * len(whole.tags))


@pytest.fixture(scope="module")
def trees(spark, site):
    return html_extract.fit(site)


def test_planted_pages_that_were_not_learned(site, trees):
    """At least 97 % of the characters kept are of the article, and 97 % of those are kept."""
    from collections import Counter
    right = extra = missed = 0
    for r in site.collect():
        for i in range(3):
            page = html_extract.parse(html_extract.planted(r.html, random.Random(10_000 + 10 * r.page_id + i)), planted=True)
            label = html_extract.weak_labels(page)
            stay = [True] * len(page.tags)
            for n in range(1, len(stay)):
                stay[n] = stay[page.parents[n]] and bool(label[n])
            want = Counter(html_extract.block_text(page, stay).split("\n"))
            got = Counter(html_extract.block_text(page, html_extract.decode(page.parents, trees.log_odds(html_extract.features(page)))).split("\n"))
            right += sum(len(s) * n for s, n in (got & want).items())
            extra += sum(len(s) * n for s, n in (got - want).items())
            missed += sum(len(s) * n for s, n in (want - got).items())
    assert right >= 0.97 * (right + extra) and right >= 0.97 * (right + missed)


def test_formulas_and_objects_keep_their_text():
    page = html_extract.parse("<p>Let <math><mi>x</mi></math> be <object>a drawing</object>.</p><script>no</script>")
    assert html_extract.block_text(page, [True] * len(page.tags)) == "Let x be a drawing."


def test_hostile_pages_take_linear_time():
    for text in ("<div>" * 20_000, "<a" * 20_000, "<" * 50_000, "<p>" * 20_000, "</x>" * 20_000, "<!--" * 20_000, "<script>" * 5_000):
        html_extract.features(html_extract.parse(text))


def test_decoding_never_keeps_a_node_in_a_dropped_one():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 8)
        parents = [-1] + [rng.randrange(i) for i in range(1, n)]
        odds = np.array([rng.uniform(-2, 2) for _ in range(n)])
        stay = html_extract.decode(parents, odds)
        best = -1e9
        for bits in range(2 ** (n - 1)):
            keep = [True] + [bool(bits >> i & 1) for i in range(n - 1)]
            if all(keep[parents[i]] for i in range(1, n) if keep[i]):
                best = max(best, sum(odds[i] for i in range(1, n) if keep[i]))
        assert all(stay[parents[i]] for i in range(1, n) if stay[i])
        assert sum(odds[i] for i in range(1, n) if stay[i]) == pytest.approx(best)


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((600, 5)).astype(np.float32)
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(int)
    odds = html_extract.boost(x, y).log_odds(x)
    assert ((odds > 0) == y).mean() > 0.97


def brute_top(vectors, queries, k, scale=64):
    good = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in vectors
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {q: a for q, a in reversed(good) if q in queries}.items():
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("n, dims, k", [(400, 64, 20), (30, 7, 20), (12, 3, 20), (300, 40, 5)])
def test_top_k_equals_brute_force(spark, n, dims, k):
    rng = np.random.default_rng(n)
    centers = rng.normal(0, 0.3, (5, dims))
    vectors = [(i, [float(np.float32(x)) for x in centers[i % 5] + rng.normal(0, 0.05, dims)]) for i in range(n)]
    vectors[3] = (3, vectors[8 % n][1])
    vectors += [(n, None), (n + 1, [None] + [0.1] * (dims - 1)), (n + 2, [float("nan")] * dims), (n + 3, [float("inf")] * dims),
                (None, [0.1] * dims), (n + 4, []), (n + 5, [0.5, 0.5])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    queries = {i for i, _ in vectors if i is not None and i % 4 == 0}
    got = topk.top_k(df.where("vec_id % 4 = 0"), df, k, candidate_rows=50, query_rows=16)
    assert sorted(map(tuple, got.collect())) == brute_top(vectors, queries, k)
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df, df.limit(0)).count() == 0


def test_large_components_are_exact(spark):
    df = spark.createDataFrame([(0, [3e6, -2e6]), (1, [1e6, 5e5]), (2, [2e6, 2e6])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df.where("vec_id = 0"), df).collect()))
    a, b, c = [[int(64 * x) for x in v] for v in ([3e6, -2e6], [1e6, 5e5], [2e6, 2e6])]
    assert got == [(0, 1, 1, a[0] * b[0] + a[1] * b[1]), (0, 2, 2, a[0] * c[0] + a[1] * c[1])]


def test_fingerprints(spark):
    rng = random.Random(5)
    docs = [(i * 3, prose(rng, rng.choice(["xx", "yy"]), rng.randint(0, 120))) for i in range(60)]
    docs[7] = (21, docs[4][1])
    docs[9] = (27, "")
    df = spark.createDataFrame(docs + [(1000, None)], "doc_id long, text string").repartition(5)
    texts = sorted(docs + [(1000, "")])
    got = {r.doc_id: r for r in fingerprint.compare_edited(df.withColumn("print", F.lit(1)), least_share=0.02, most_share=0.6).collect()}
    for i, (d, t) in enumerate(texts):
        cut = len(t) // 4
        edited = t[:len(t) - cut] + texts[(i + 1) % len(texts)][1][:cut]
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        if edited == t:
            assert got[d].near_edited == 1 and got[d].edited_fingerprint == got[d].fingerprint
    assert got[21].fingerprint == got[12].fingerprint and got[27].fingerprint == got[1000].fingerprint
    assert len({r.fingerprint for r in got.values()}) > 50
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.2


def test_fingerprints_of_few_repeated_and_null_rows(spark):
    schema = "doc_id long, text string"
    one = fingerprint.compare_edited(spark.createDataFrame([(5, "abcd efgh")], schema)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest() and one.near_next == 1
    rows = fingerprint.compare_edited(spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c d"), (None, "e f g h")], schema)).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]
    assert fingerprint.compare_edited(spark.createDataFrame([], schema)).count() == 0
