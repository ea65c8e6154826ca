"""The training-data operators against brute force on small fixtures, and their odd cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import fuzzyhash, htmltext, jaccard, langid, mixing, packing, quality, queries, secret_scan, sharding, substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, n long, key string, node long"
WORD = re.compile("[^\x20\x09-\x0d]+")
SF = "/root/testdata/sf0.001"


def odd_rows():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 6))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    base, passage = prose(120), prose(50)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " \n\t ", "one", "a b c d", "A B C D", "a b c d e", base, base, " ".join(near), prose(30) + " " + passage, passage + "\n" + prose(30), prose(4000), passage * 2, "x " * 100, "line one two\nline one two\n\n \nline", "\x85 nbsp\xa0word\x1c tail"]
    texts += [prose(rng.randint(1, 90)) for _ in range(20)]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", None])) for i, t in enumerate(texts)]
    rows.append(rows[7])
    rows.append((None, base, "en", "s1"))
    return [(i, t, lang, s, None if t is None else len(t), "clash", 1, "k", 2) for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


# --- secrets


def brute_spans(text):
    text, found = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A | re.I):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            found.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            found.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


def test_secret_spans_equal_plain_search():
    machine, rng = secret_scan.build_automaton(), random.Random(1)
    parts = ["password", "Token", "secret", "API_KEY", "apikey", "=", ": ", " ", '"', "é", "İ", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "abc", "passwd", "_", "-", "tokentoken", "\n"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        got = [f"{k}:{a}:{b}" for a, b, k in secret_scan.scan_text(text, machine) if k in secret_scan.KINDS[:3]]
        assert got == brute_spans(text), text


def test_checksums_decide():
    machine, body = secret_scan.build_automaton(), "abcdefghijABCDEFGHIJ0123456789"
    good = f"x ghp_{body}{secret_scan.crc_base62(body)} y"
    assert [k for _, _, k in secret_scan.scan_text(good, machine)] == ["github"]
    assert secret_scan.scan_text(good.replace("abc", "abd"), machine) == []
    key = "xprv9s21ZrQH143K3QTDL4LXw2F7HEK3wJUD2nW2nRk4stbPy6cq3jPPqjiChkVvvNKmPGJxWUtg6LnF5kejMRNNU3TGtRBeJgk33yuGBxrMPHi"
    assert [k for _, _, k in secret_scan.scan_text(key, machine)] == ["xprv"]
    assert secret_scan.scan_text(key[:-1] + "j", machine) == []
    assert secret_scan.bech32_checked("A12UEL5L") and not secret_scan.bech32_checked("A12UEL5Q")


def test_secret_digest_and_masks(spark, empty):
    rows = [(1, 'say token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" é', 5), (2, None, None), (3, "clean", 5), (3, "clean", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = secret_scan.secret_digests(df).orderBy("doc_id").collect()
    base = ",".join(brute_spans(rows[0][1]))
    assert len(got) == 4 and got[0]["spans"] == base and got[0]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and got[1]["spans"] == ""
    masked = secret_scan.redact_secrets(df).orderBy("doc_id").collect()
    assert masked[0]["text"] == 'say [SECRET]" é' and masked[0]["n_chars"] == len(masked[0]["text"]) and masked[1]["text"] is None
    assert secret_scan.scan_secrets(df).where(F.size("secret_spans") > 0).count() == 1
    assert secret_scan.secret_digests(empty).count() == 0


# --- quality


def test_quality_counts(docs, empty):
    got = quality.quality_digests(docs).collect()
    want = []
    for i, t, *_ in odd_rows():
        w = words_of(t)
        lines, seen, dups = (t or "").split("\n"), set(), 0
        for x in lines:
            if words_of(x):
                dups += x in seen
                seen.add(x)
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        inside = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dups, len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in got), key=key) == sorted(want, key=key)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality.quality_digests(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_divergence_keeps_clean_and_rejects_junk(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    junk = rows.where("doc_id % 10 = 0 and length(text) > 800").select((F.col("doc_id") + 10**6).alias("doc_id"), F.regexp_replace("text", " ", "### ").alias("text"), "lang")
    got = quality.quality_digests(rows.union(junk))
    assert got.where("doc_id >= 1000000 and kept").count() < 0.2 * got.where("doc_id >= 1000000").count()
    clean = got.where("doc_id < 1000000 and not base_failed and n_symbols < 2")
    assert clean.where("not kept").count() <= 0.02 * clean.count()
    kept = {r["doc_id"] for r in quality.quality_digests(rows).where("kept").collect()}
    assert {r["doc_id"] for r in quality.keep_good(rows).collect()} == kept


def common_texts():
    """Clean texts with a fifth of common words, and as long ones of the same characters without any."""
    rng, common = random.Random(5), quality.COMMON_WORDS["en"].split()
    made = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(3000)]
    made = [w for w in made if w.encode() not in quality.VOCABULARY]
    clean = [[rng.choice(common if rng.random() < 0.2 else made) for _ in range(n)] for n in [60] * 20 + [100] * 40 + [200] * 60 + [800] * 80]
    bare = [[w if w not in common else rng.choice(made[:50]) for w in text] for text in clean]
    return [" ".join(t) for t in clean], [" ".join(t) for t in bare]


def test_texts_without_common_words_are_rejected(spark):
    clean, bare = common_texts()
    rows = [(i, t, "en") for i, t in enumerate(clean)] + [(1000 + i, t, None) for i, t in enumerate(bare)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality.quality_digests(docs).collect()
    assert max(r["char_distance"] for r in got) < 0.1  # their characters do not tell them apart
    assert not any(r["kept"] for r in got if r["doc_id"] >= 1000)
    assert sum(r["kept"] for r in got if r["doc_id"] < 1000) >= 0.99 * len(clean)
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == {r["doc_id"] for r in got if r["kept"]}


def test_long_texts_without_letters_are_judged(spark):
    rng = random.Random(6)
    clean, _ = common_texts()
    odd = [" ".join(str(rng.randrange(10**6)) for _ in range(3000)), " ".join("".join(rng.choices("=+~^/@", k=5)) for _ in range(400)), " ".join(rng.choice("abcdefghij") for _ in range(90))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean)] + [(1000 + i, t, None) for i, t in enumerate(odd)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality.quality_digests(docs).where("doc_id >= 1000").collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert [got[1000 + i]["kept"] for i in range(3)] == [False, False, True]  # the last is too short to judge
    assert {r["doc_id"] for r in quality.keep_good(docs).where("doc_id >= 1000").collect()} == {1002}


def test_words_do_not_judge_a_language_outside_the_list():
    reference = np.zeros((1, quality.N_WORD))
    reference[0, -1] = 5000
    assert (quality.word_limits(reference, quality.QualityRules()) == quality.QualityRules().max_word_distance).all()


def test_js_distance_is_a_metric_between_0_and_1():
    a = np.array([[1.0, 0, 0], [1, 1, 0], [0, 0, 0]])
    got = quality.js_distances(a, np.array([[2.0, 0, 0], [0, 0, 5]]))
    assert got[0].tolist() == [0, 1] and 0 < got[1, 0] < 1 and got[2].tolist() == [1, 1]


# --- fingerprints


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 70))) for _ in range(2))
        assert fuzzyhash.edit_distance(a, b) == levenshtein(a, b)


def test_fingerprint_digest_equals_plain_walk(spark, docs, empty):
    rows = sorted(((i, t or "") for i, t, *_ in odd_rows()), key=lambda r: (-r[0] if r[0] is not None else 1, zlib.crc32(r[1].encode()), r[1]))
    want = []
    for k, (i, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        new = text[: len(text) - cut] + other[:cut]
        a, b, c = map(fuzzyhash.fingerprint, (text, new, other))
        want.append((str(i), len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, fuzzyhash.likeness(a, b), fuzzyhash.likeness(a, c)))
    got = [(str(r[0]), *r[1:]) for r in fuzzyhash.fingerprint_digest(docs).collect()]
    assert sorted(got) == sorted(want)
    assert fuzzyhash.fingerprint_digest(empty).count() == 0
    one = fuzzyhash.fingerprint_digest(spark.createDataFrame([(1, "abc")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_likeness_tells_edits_from_strangers(spark):
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 1500").select("text").limit(60).collect()]
    marks = list(map(fuzzyhash.fingerprint, texts))
    edits = [fuzzyhash.likeness(m, fuzzyhash.fingerprint(t[:700] + "XY" + t[720:])) for m, t in zip(marks, texts, strict=True)]
    assert sum(e > 0.6 for e in edits) >= 0.9 * len(edits)
    strangers = [fuzzyhash.likeness(a, b) for a, b, s, t in zip(marks, marks[1:], texts, texts[1:], strict=False) if s[:200] != t[:200]]
    assert sum(x > 0.3 for x in strangers) <= 0.05 * len(strangers)


# --- pages


def test_page_text():
    page = """<!DOCTYPE html><html><head><title>t</title><script>var x="</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav>
    <div class="ad">Buy now cheap.</div><article><h1>Head &amp; line</h1><p><b>First   para
    graph is here, long enough to matter.<br><p>Second &lt;one&gt; follows it, with words &copy; and more.</article><div class="comments"><p>I like it</p></div><footer>&copy; foot</footer>"""
    trees = htmltext.model()
    assert htmltext.extract_pages([page, "", None, "plain text &amp; more"], trees) == ["Head & line\nFirst para graph is here, long enough to matter.\nSecond <one> follows it, with words © and more.", "", "", "plain text & more"]


def test_held_out_pages_and_consistency():
    trees, rng = htmltext.model(), random.Random(99)
    good = bad = missed = 0
    for _ in range(150):
        page = htmltext._make_page(rng)
        nodes, pieces = htmltext.parse(page)
        got = htmltext.extract_pages([page], trees)[0].split()
        good += sum("ñ" in w for w in got)
        bad += sum("ñ" not in w for w in got)
        missed += sum("ñ" in w for _, _, t in pieces for w in t.split()) - sum("ñ" in w for w in got)
        kept = htmltext.decode(nodes, trees.log_odds(np.array(htmltext.features(nodes))))
        assert all(kept[x.parent] for i, x in enumerate(nodes) if i and kept[i])
    assert good / (good + bad) > 0.97 and good / (good + missed) > 0.97


def test_place_among_many_siblings():
    for n in (3, 63, 64, 200):
        nodes, _ = htmltext.parse("<html><body><article>" + "<p>some words here.</p>" * n + "</article></body></html>")
        rows = np.array(htmltext.features(nodes))
        own = [i for i, x in enumerate(nodes) if x.tag == "p"]
        column = rows.shape[1] - 4
        assert len(own) == n and rows[own, column].tolist() == [k / n for k in range(n)]


def test_long_articles_are_whole():
    trees, rng = htmltext.model(), random.Random(41)
    good = bad = missed = 0
    for n in (64, 100, 184, 300) * 5:
        said = lambda k, good: " ".join("".join(rng.choices("abdeghilmnoprstu", k=5)) + ("ñ" if good else "") for _ in range(k)) + "."
        page = f"<html><body><nav><ul><li><a href=/>{said(1, False)}</a></li><li><a href=/a>{said(2, False)}</a></li></ul></nav><article><h1>{said(4, True)}</h1>" + "".join(f"<p>{said(rng.randint(3, 60), True)}</p>" for _ in range(n)) + f"</article><footer>&copy; {said(9, False)}</footer></body></html>"
        got = htmltext.extract_pages([page], trees)[0].split()
        good += sum("ñ" in w for w in got)
        bad += sum("ñ" not in w for w in got)
        missed += page.count("ñ") - sum("ñ" in w for w in got)
    assert good / (good + bad) > 0.99 and good / (good + missed) > 0.99


def test_hidden_is_an_attribute_of_its_own():
    shown = ('title="The hidden cost"', 'data-title="Hidden gems"', 'data-hidden="false"', "data-x='a hidden b'", 'data-style="display:none"', "href=/hidden", 'title="id=nav class=ad"')
    gone = ("hidden", 'class="a" hidden', 'HIDDEN=""', 'aria-hidden="true"', "aria-hidden=true id=x", 'style="color:red; display: none"', "hidden/")
    assert not any(htmltext._attributes(f" {raw}")[1] for raw in shown) and all(htmltext._attributes(f" {raw}")[1] for raw in gone)
    assert not any(sum(htmltext._attributes(f" {raw}")[0]) for raw in shown)
    body = "<p>First paragraph of the article, long enough to matter.</p>" * 3
    assert htmltext.extract_pages([f'<html><body><article title="The hidden cost">{body}</article></body></html>'], htmltext.model())[0].count("First paragraph") == 3


def test_broken_pages():
    trees = htmltext.model()
    for page in ("<", "<p", "<!--", "<a href='", "</div></p>", "<table><tr><td>x", "<p>a<p>b<li>c", "<script>", "<style>a", "<b><i>x</b>y</i>", "<div " * 50, "&#x110000; &bogus;"):
        htmltext.extract_pages([page], trees)


@pytest.mark.parametrize("page", ["<p" * 100_000, "<div>" * 100_000 + "text" + "</div>" * 100_000, "<a '" * 250_000, "<a \"" * 125_000 + "<b '>" * 100_000, "<a '\">x" * 150_000, "<select>" * 100_000, "<p><td>" + "<div>" * 60_000, "<!--" * 100_000, "<" * 500_000, "<p " + " " * 900_000 + "x>", "&amp" * 200_000])
def test_hostile_pages_take_linear_time(page):
    import time

    began = time.process_time()
    nodes, pieces = htmltext.parse(page)
    assert time.process_time() - began < 4 and len(nodes) <= 1 + page.count("<")


def brute_tags(page):
    """Tags by a plain pattern, which takes cubic time at worst."""
    pattern = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>"']*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|</?[a-zA-Z][^>]*>""", re.S)
    return [(m.start(), m.end(), (m[2] or "").lower(), m[1] == "/", m[3] or "") for m in pattern.finditer(page)]


def test_tags_equal_a_plain_pattern():
    rng = random.Random(31)
    parts = ["<", ">", "<p", "</", "a", " ", "\"", "'", "=", "<!--", "-->", "<!", "<?", "/", "x='1>2'", "</p>", "<b c=\"d\">", "\n", "<1"]
    for _ in range(20_000):
        page = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert list(htmltext.tags(page)) == brute_tags(page), page


#: Shapes that the generator does not make, labelled by hand: (page, text).
SHAPES = [
    ("""<html><body><div id="page"><div id="masthead"><h2><a href="/">The Daily</a></h2></div><div id="nav"><a href="/1">World</a> <a href="/2">Sport</a></div><div class="story-body"><h1>River rises again</h1>
<p>The river rose for a third day, officials said on Monday, and boats were tied up along the whole bank.</p><p>Nobody was hurt, but two bridges stay closed until the water falls.</p></div>
<div class="comments"><h3>Comments</h3><p>First!</p></div><div id="footer">Copyright The Daily. All rights reserved.</div></div></body></html>""",
     "River rises again\nThe river rose for a third day, officials said on Monday, and boats were tied up along the whole bank.\nNobody was hurt, but two bridges stay closed until the water falls."),
    ("""<body><header><nav><a href=a>Home</a><a href=b>Docs</a></nav></header><main><article><h1>Install</h1><p>Download the file and unpack it into a folder of your own choice.</p><pre>tar xf file.tar</pre>
<p>Then run the program once, so that it can write its settings.</p></article></main><aside class=sidebar><ul><li><a href=c>Older versions</a></li><li><a href=d>Mirrors</a></li></ul></aside><footer>Made by us</footer></body>""",
     "Install\nDownload the file and unpack it into a folder of your own choice.\ntar xf file.tar\nThen run the program once, so that it can write its settings."),
    ("""<html><body><div class="cookie-banner"><p>We use cookies to improve your visit.</p><button>Accept</button></div><article class="post"><h1>Bread</h1><p>Mix flour, water and salt, and leave the dough alone for a night.</p><ul><li>500 g flour, sifted twice</li><li>350 g water, a little warm</li></ul>
<p>Bake it hot, and do not cut it before it is cold.</p></article><form action="/s"><label>Join our list</label><input><button>Go</button></form></body></html>""",
     "Bread\nMix flour, water and salt, and leave the dough alone for a night.\n500 g flour, sifted twice\n350 g water, a little warm\nBake it hot, and do not cut it before it is cold."),
]


@pytest.mark.parametrize("page, want", SHAPES)
def test_pages_labelled_by_hand(page, want):
    assert htmltext.extract_pages([page], htmltext.model())[0] == want


def test_pages_query(spark):
    got = queries.QUERIES["op4_html_extraction"](spark, SF)
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in got.collect():
        inner = re.search("<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        import html

        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


# --- language


def test_language(spark, docs, empty):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.language_digest(rows).join(rows.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
    for r in langid.language_digest(docs).collect():
        text = {i: t for i, t, *_ in odd_rows()}[r["doc_id"]]
        assert (r["lang_pred"] == "und") == (not text or not any(c.isalpha() for c in text))
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert langid.language_digest(empty).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.language_digest(unlabelled).collect()} == {"und"}


# --- substrings


def brute_repeats(rows, window):
    count = Counter(tuple(w[k : k + window]) for _, w in rows for k in range(len(w) - window + 1))
    out = []
    for i, w in rows:
        gone = {k + j for k in range(len(w) - window + 1) if count[tuple(w[k : k + window])] > 1 for j in range(window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("rules", [substrings.RepeatRules(), substrings.RepeatRules(window=9, gram=4, frequent=3, shard_words=50, remembered=5)])
def test_repeats_equal_brute_force(docs, empty, rules):
    got = [(str(r[0]), r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in substrings.remove_repeats(docs, rules).collect()]
    assert sorted(got) == brute_repeats([(i, words_of(t)) for i, t, *_ in odd_rows()], rules.window)
    assert substrings.repeat_digest(empty).count() == 0


def test_automaton_counts_places():
    rng = random.Random(4)
    for _ in range(60):
        seqs = [(["abc"[rng.randint(0, 2)] for _ in range(rng.randint(3, 25))], rng.randint(1, 2)) for _ in range(5)]
        machine = substrings.SuffixAutomaton()
        for s, n in seqs:
            machine.add(s, n)
        machine.close()
        count = Counter()
        for s, n in seqs:
            for k in range(len(s) - 2):
                count[tuple(s[k : k + 3])] += n
        for s, _ in seqs:
            assert machine.repeated(s, 3) == sum(1 << k for k in range(len(s) - 2) if count[tuple(s[k : k + 3])] > 1)


def test_streamed_words_that_the_automaton_lacks():
    rng = random.Random(14)
    for _ in range(200):
        known = [rng.choices("abcd", k=rng.randint(1, 30)) for _ in range(3)]
        machine = substrings.SuffixAutomaton()
        for s in known:
            machine.add(s, 1)
        machine.close()
        count = Counter(tuple(s[k : k + 4]) for s in known for k in range(len(s) - 3))
        for text in [*known, rng.choices("abcdxy", k=60), list("xyz")]:
            assert machine.repeated(text, 4) == sum(1 << k for k in range(len(text) - 3) if count[tuple(text[k : k + 4])] > 1)


# --- shards


def test_shards(docs, empty):
    got = sharding.sharded(docs).collect()
    assert len(got) == len(odd_rows())
    assert all(r["grown_shard"] in (r["shard"], 24) for r in got)
    for s in range(24):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    text = {i: t for i, t, *_ in odd_rows()}
    assert all(r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode()) and r["size"] == len((text[r["doc_id"]] or "").encode()) + 8 for r in got if r["doc_id"] is not None)
    assert sharding.sharded(empty).count() == 0


def test_shards_follow_weights_and_move_only_in(spark):
    ids = spark.range(20000).select(F.col("id").alias("doc_id"))
    for n in (8, 16, 24):  # full regions: one more shard takes documents only into itself
        both = sharding.assign_shards(sharding.assign_shards(ids, sharding.tree(n)), sharding.tree(n + 1), out_col="grown")
        assert both.where(f"grown <> shard and grown <> {n}").count() == 0 and both.where(f"grown = {n}").count() > 0.5 * 20000 / (n + 1)
    for n in (1, 5, 13, 21, 25):  # elsewhere documents come into the subtree that grows; inside other subtrees nothing moves
        both = sharding.assign_shards(sharding.assign_shards(ids, sharding.tree(n)), sharding.tree(n + 1), out_col="grown")
        grown = sharding.tree(n + 1)[-1]
        region = lambda c: F.floor(F.col(c) / 8)
        rack = lambda c: F.floor(F.col(c) / 4)
        moved = both.where("grown <> shard")
        assert moved.where(region("grown") != grown.region).count() == 0
        assert moved.where((region("shard") == grown.region) & (rack("grown") != grown.rack)).count() == 0
        assert moved.where((rack("shard") == grown.rack) & (F.col("grown") != grown.shard)).count() == 0
    leaves = sharding.tree(4, 2, 1)
    heavy = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 1 else 1.0) for x in leaves]
    counts = dict(sharding.assign_shards(ids, heavy).groupBy("shard").count().collect())
    assert all(abs(counts[k] / 20000 - (0.5 if k == 1 else 1 / 6)) < 0.02 for k in range(4))
    moved = sharding.assign_shards(sharding.assign_shards(ids, leaves), heavy, out_col="after").where("after <> shard")
    assert moved.count() > 0 and moved.where("shard in (2, 3) and after in (2, 3)").count() == 0 and moved.where("shard = 1").count() == 0


def test_shards_equal_a_walk_down_the_tree(spark):
    import math

    def draw(key, name, weight):
        h = int(hashlib.md5(f"{key}:{name}".encode()).hexdigest()[:12], 16)
        return -math.log((2.0**48 - h) / float(2**48 + 1)) / weight

    leaves = [sharding.Leaf(x.region, x.rack, x.shard, 1.0 + x.shard % 3) for x in sharding.tree(13)]
    for r in sharding.assign_shards(spark.range(500).select(F.col("id").alias("doc_id")), leaves).collect():
        here = leaves
        for level, mark in (("region", "r"), ("rack", "k"), ("shard", "s")):
            weights = Counter()
            for x in here:
                weights[getattr(x, level)] += x.weight
            best = min(weights, key=lambda c: (draw(r["doc_id"], f"{mark}{c}", weights[c]), c))
            here = [x for x in here if getattr(x, level) == best]
        assert r["shard"] == here[0].shard


# --- mixing


def test_mix_is_fair(spark, docs, empty):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 6, "big").when(F.col("id") % 10 < 9, "mid").otherwise("small").alias("source"))
    for weights in (None, {"big": 0.5, "mid": 0.3, "small": 0.2}):
        got = mixing.mix_sources(rows, weights, block_rows=8, period=60).toPandas()
        assert len(got) == 4000 and ((got.mix_slot >= got.mix_release) & (got.mix_slot < got.mix_due)).all()
        blocks = got.drop_duplicates(["source", "mix_block"])
        assert blocks.mix_slot.is_unique
        shares = {r["source"]: r["share"] for r in mixing.source_shares(rows, weights, 60).selectExpr("inline(shares)").collect()}
        end = blocks.groupby("source").mix_slot.max().min()
        for t in range(1, end + 1, 7):
            for s, a in shares.items():
                assert abs((blocks[blocks.source == s].mix_slot < t).sum() - t * a / 60) < 1
    odd = mixing.mix_sources(docs, block_rows=2).collect()
    assert len(odd) == len(odd_rows()) and len({(r["mix_slot"], r["mix_row"]) for r in odd}) == len(odd)
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_order(docs).columns == docs.columns


def brute_mix(counts, shares, period, block):
    """Slots of each source's blocks by earliest deadline first, slot by slot."""
    need = {s: -(-n // block) for s, n in counts.items()}
    done, slots, t = dict.fromkeys(counts, 0), {}, 0
    while any(done[s] < need[s] for s in counts):
        ready = [(-(-(done[s] + 1) * period // shares[s]), s) for s in counts if done[s] * period // shares[s] <= t]
        if ready:
            s = min(ready)[1]
            if done[s] < need[s]:
                slots[s, done[s]] = t
            done[s] += 1
        t += 1
    return slots


def test_mix_equals_slot_by_slot_scheduling(spark):
    rng = random.Random(17)
    for block, period, weights in ((4, 30, {"a": 0.5, "b": 0.3, "c": 0.2}), (1, 24, {"a": 0.7, "b": 0.2, "c": 0.1}), (3, 12, None)):
        rows = [(i, rng.choice("aaab" if i % 2 else "abc")) for i in range(700)]
        df = spark.createDataFrame(rows, "doc_id long, source string")
        shares = {r["source"]: r["share"] for r in mixing.source_shares(df, weights, period).selectExpr("inline(shares)").collect()}
        got = {(r["source"], r["mix_block"]): r["mix_slot"] for r in mixing.mix_sources(df, weights, block, period).collect()}
        assert got == brute_mix(Counter(s for _, s in rows), shares, sum(shares.values()), block)


def test_mix_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    rows = [(None if i == 7 else i, None if i % 50 == 0 else "hot" if i % 3 else f"s{i % 11}") for i in range(60_000)]
    for part in (rows, rows[:5], []):
        df = spark.createDataFrame(part, "doc_id long, source string")
        con = duckdb.connect()
        con.register("documents", df.toArrow())
        found = con.execute(mixing.ORACLE_SQL)
        names = [c[0] for c in found.description]
        got = mixing.mix_digest(df)
        order = lambda r: tuple((x is not None, x) for x in r)
        assert sorted(map(tuple, got.select(names).collect()), key=order) == sorted(found.fetchall(), key=order) and sorted(names) == sorted(got.columns)


def test_clashing_names_pass_through(spark):
    names = ["_row", "_hash", "_s", "_turn", "_share2", "_key", "_n", "_before", "_rank", "_sub", "_Digest", "_none", "MIX_SLOT", "mix_row"]
    rows = [(i, f"some words of text number {i} that go on for a while", "s", *[f"{n}{i}" for n in names]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    for made in (mixing.mixed_order(df), jaccard.keep_one_of_each(df)):
        assert made.columns == df.columns and sorted(map(tuple, made.collect())) == sorted(rows)


def test_mix_plan_is_native(spark, docs):
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- packing


def test_pieces():
    for n in [*range(1, 300), 2047, 2048, 2049, 4096, 5000]:
        p = packing.pieces_of(n)
        assert sum(p) == n and all(x & x - 1 == 0 for x in p) and p == sorted(p, reverse=True) and p.count(2048) == n // 2048


def test_ids_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, cached, rng = Tokenizer.from_file(path), packing.WordIds(path, 50), random.Random(6)
    parts = ["don't", "WE'LL", "ÀÉß", "é", "İ", "Σας", "42", "x_y", "#!?", "<|endoftext|>", "<", "日本", " ", "\xa0", "\t", "\n", " ", "naïve,", "a" * 300, "😀", "\x85", "ﬁ", "Ǆ", "K"]
    for _ in range(400):
        text = "".join(rng.choice(["", " ", "\n"]) + rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert cached.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack_documents(docs).collect()
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t, *_ in odd_rows()}
    times = Counter(i for i, *_ in odd_rows())
    for i, want in ids.items():
        mine = [r for r in got if r["doc_id"] == i]
        spans = Counter((r["start"], r["length"]) for r in mine)
        assert set(spans.values()) == {times[i]} and sum(n for _, n in spans) == len(want)
        assert all(r["ids"] == want[r["start"] : r["start"] + r["length"]] and r["doc_tokens"] == len(want) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) for r in mine)
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got))) and {r["offset"] for r in got} == {0}
    ordered = sorted(got, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in ordered] == sorted((r["length"] for r in got), reverse=True)
    assert packing.pack_documents(empty).count() == 0


# --- n-gram join


def brute_components(rows, n=5, percent=75):
    sets = {}
    for i, t in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words_of(t)]
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def family_rows():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(400)]
    rows, shared = [], rng.choices(vocabulary, k=70)
    for family in range(14):
        base = rng.choices(vocabulary, k=rng.choice([3, 6, 9, 14, 30, 80, 200]))
        for _ in range(rng.choice([1, 3, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rows += [" ".join(shared + rng.choices(vocabulary, k=rng.choice([8, 15, 20, 26]))) for _ in range(25)]
    rows += ["A B C", "a b c", "", None]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("cost", [None, 0.0, 1e9])
def test_join_equals_brute_force(spark, monkeypatch, cost):
    if cost is not None:
        monkeypatch.setattr(jaccard, "SCAN_COST", cost)
    rows = family_rows()
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(rows)


def test_join_links_sets_of_different_size(spark):
    rng = random.Random(12)
    made = iter(["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(4000)])
    texts = ["river fire green wind house tree night", "river fire green wind house tree night sea"]
    for n in [7] * 20 + [8] * 10 + [11] * 10 + [15] * 10 + [16] * 10 + [19] * 10:
        base = [next(made) for _ in range(n)]
        more = [next(made) for _ in range((n - 4) // 3)]
        texts += [" ".join(base), " ".join(base + more if rng.random() < 0.5 else more + base)]
    rows = list(enumerate(texts))
    want = brute_components(rows)
    assert all(want[i][1] == i - i % 2 for i in want)  # every pair links
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want


def test_join_of_a_shared_passage_that_does_not_link(spark):
    rng = random.Random(19)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrst", k=6))
    passage, near = [word() for _ in range(60)], [word() for _ in range(90)]
    rows = [" ".join(passage + [word() for _ in range(rng.randint(8, 18))]) for _ in range(500)]
    rows += [" ".join([w if rng.random() > 0.02 else word() for w in near]) for _ in range(150)]
    rows = list(enumerate(rows))
    want = brute_components(rows)
    made = []
    pairs = jaccard._pairs
    try:
        jaccard._pairs = lambda *a: (made.append(pairs(*a)), made[-1])[1]
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        jaccard._pairs = pairs
    assert got == want and len({c for _, c in want.values()}) > 250 and len(made) <= 3


def test_join_rows_without_ids(spark):
    rng = random.Random(23)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(40)) for _ in range(60)]
    rows = [(None, t) for t in texts] + [(None, t + " tail") for t in texts] + [(1, texts[0] + " end")]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 121 and sum(r["component_id"] == 1 for r in got) == 3 and sum(r["component_id"] is None for r in got) == 118


def test_join_odd_rows(docs, empty):
    rows = [(i, t) for i, t, *_ in odd_rows()]
    want = brute_components([r for r in rows if r[0] is not None])
    got = jaccard.jaccard_components(docs).collect()
    assert len(got) == len(rows) and all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    assert jaccard.jaccard_components(empty).count() == 0


def test_one_row_of_each_component_is_kept(spark):
    rng = random.Random(21)
    text = [" ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(30)) for _ in range(8)]
    near = text[0] + " tail"
    rows = [
        (None, text[0], "a"), (None, text[1], "a"), (None, text[2], "a"), (None, text[2], "a"), (None, near, "b"),  # ids of null, each text its own
        (5, text[3], "a"), (5, text[4], "a"), (5, text[4] + " tail", "a"),  # an id of several texts
        (7, text[5], "a"), (3, text[5] + " tail", "a"), (None, text[5], "a"), (9, text[5], "a"), (3, text[5] + " tail", "a"),
        (jaccard.NULL_ID, text[6], "a"), (None, text[7], "a"),
        (None, None, "a"), (None, "", "a"), (4, " \n", "a"), (4, "", "a"),
    ]
    got = [tuple(r) for r in jaccard.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)).collect()]
    firsts = [r for r in got if r[1] in (text[0], near)]
    fours = [r for r in got if r[1] in (text[4], text[4] + " tail")]
    assert len(firsts) == 1 and len(fours) == 1
    rest = [(None, text[1], "a"), (None, text[2], "a"), (5, text[3], "a"), (3, text[5] + " tail", "a"), (jaccard.NULL_ID, text[6], "a"), (None, text[7], "a"), *rows[-4:]]
    assert sorted(map(str, got)) == sorted(map(str, rest + firsts + fours))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(queries.ORACLES[name])
    names = [c[0] for c in found.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(names) == sorted(got.columns)
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.select(names).collect()), key=order) == sorted(found.fetchall(), key=order)
