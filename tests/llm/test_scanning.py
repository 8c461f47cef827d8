"""Page text, archives, secrets, languages and toxicity: by hand, by brute force, by round trip, by held-out rows."""

import hashlib
import random
import re
import string
import time
import zlib

import duckdb
import numpy as np
import pyarrow.fs
import pytest

import oracle
from sluiceway.llm import html_text, langid, ngrams, pipeline_sql, queries, secret_scan, toxicity, warc
from sluiceway.session import scratch_dir

SF = "/root/testdata/sf0.01"
PROSE = "A paragraph, with commas, and enough words to count as running text of the page."


# ---- pages -------------------------------------------------------------------


def test_article_without_furniture():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="with-sidebar">
    <header><h1>Site</h1><ul><li><a href="/">Home</a></li></ul></header><div id="cookieNotice">{PROSE}</div>
    <div class="wrap"><article><h1>Head &amp; line</h1><p>{PROSE}</p><script>var a = "</p>";</script>
    <p>Short.</p><div class="ad">{PROSE}</div><p>Line<br>break &lt;b&gt; &#8212; &eacute; &amp no</p>
    <ul><li>One<li>Two</ul><form><p>{PROSE}</p></form><section class="comments"><p>{PROSE}</p></section></article>
    <div class="sidebar"><p>{PROSE}</p></div></div><!-- <p>{PROSE}</p> --><footer>{PROSE}</footer></body></html>"""
    want = ["Head & line", PROSE, "Short.", "Line break <b> — é & no", "One", "Two"]
    assert html_text.main_text(page) == "\n\n".join(want)


@pytest.mark.parametrize(
    "wrapper", ["content-sidebar-wrap", "site has-sidebar", "no-sidebar", "elementor-widget", "with-comments", "ad-free", "widget search-page"]
)
def test_names_of_wrappers_do_not_lose_the_article(wrapper):
    text = f"<p>{PROSE}</p><p>{PROSE}</p>"
    side = f'<div class="sidebar"><p>{PROSE}</p></div><div id="comments"><p>{PROSE}</p></div>'
    want = f"{PROSE}\n\n{PROSE}"
    for inner in (f"<main>{text}</main>", f"<article>{text}</article>", f"<div>{text}{text}</div>"):
        page = f'<body><h1>Title</h1><p>A tagline of the whole site</p><div class="{wrapper}">{inner}{side}</div></body>'
        got = html_text.main_text(page)
        assert got.count(PROSE) == page.count(PROSE) - 2, (inner, got)
        assert want in got


@pytest.mark.parametrize("around", ["<main>{}</main>", "<div>{}</div>", "<article>{}</article>"])
def test_a_name_on_every_block_means_nothing(around):
    block = '<div class="elementor-widget elementor-widget-text-editor"><div class="elementor-widget-container">{}</div></div>'
    title = block.replace("text-editor", "heading").format("<h2>Part</h2>")
    blocks = [f"{i} {PROSE}" for i in range(6)]
    page = "<body><h1>Title</h1>" + around.format(title + "".join(block.format(f"<p>{x}</p>") for x in blocks))
    got = html_text.main_text(page + f'<div class="sidebar"><p>{PROSE}</p></div></body>')
    assert [x for x in got.split("\n\n") if x != "Title"] == ["Part", *blocks]


def test_sections_and_headings_of_an_article_stay():
    page = f"""<body><article><h1>T</h1><p>{PROSE}</p><section id="related-work"><h2 id="search-results">Found</h2><p>1 {PROSE}</p>
    </section><section class="comments"><p>{PROSE}</p></section><div class="related"><p>{PROSE}</p></div></article></body>"""
    assert html_text.main_text(page) == f"T\n\n{PROSE}\n\nFound\n\n1 {PROSE}"


def test_comments_go_though_they_outweigh_the_article():
    comments = f'<div class="comment"><p>{PROSE}</p></div>' * 20
    for post in (f"<article><p>1 {PROSE}</p></article>", f"<div><p>1 {PROSE}</p><p>2 {PROSE}</p><p>3 {PROSE}</p></div>"):
        got = html_text.main_text(f'<body>{post}<div id="comments">{comments}</div></body>')
        assert got == "\n\n".join(f"{i} {PROSE}" for i in range(1, 1 + post.count("<p>")))
    assert html_text.main_text(f"<body><h1>Thread</h1>{comments}</body>").count(PROSE) == 20
    related = '<div class="related"><article><p>A short teaser, with a comma.</p></article></div>'
    assert html_text.main_text(f"<main><article>{f'<p>{PROSE}</p>' * 5}</article>{related}</main>") == "\n\n".join([PROSE] * 5)


ONLY = [
    '<div class="cookie-banner"><p>{0}</p></div>', '<div id="comments"><p>{0}</p><p>{0}</p></div>', '<div class="sidebar"><p>{0}</p></div>',
    '<form><label>The name that you chose for yourself</label><input><input type="password"><button>Log in</button></form>',
    '<div class="login-form"><p>{0}</p></div>', '<div class="newsletter signup"><p>{0}</p></div>', '<div role="alert"><p>{0}</p></div>',
    '<section id="comment-list"><p>{0}</p></section>', '<div class="advertisement"><p>{0}</p></div>',
]


@pytest.mark.parametrize("only", ONLY)
def test_what_is_no_article_for_certain_never_wins(only):
    """Alone it leaves the page empty; beside a short article, with or without semantic tags, it goes."""
    furniture = only.format(PROSE)
    assert html_text.main_text(f"<html><body>{furniture}</body></html>") == ""
    for short in ("<article><h1>Title</h1><p>Short text.</p></article>", "<main><h1>Title</h1><p>Short text.</p></main>"):
        for page in (short + furniture * 3, furniture + short, f"<div class='content-sidebar-wrap'>{short}{furniture}</div>"):
            assert html_text.main_text(f"<body>{page}</body>") == "Title\n\nShort text."
    plain = '<div id="content"><p>The meeting is on Monday, at nine.</p></div>'
    assert html_text.main_text(f"<body>{plain}{furniture * 2}</body>") == "The meeting is on Monday, at nine."
    # What holds the article is never furniture.
    inside = furniture.replace(PROSE, f"<article><p>{PROSE}</p></article>")
    if inside != furniture:
        assert html_text.main_text(f"<body>{inside}</body>").count(PROSE) >= 1


def test_a_share_bar_inside_the_main_part_goes():
    page = f'<main><h1>T</h1><p>{PROSE}</p><section class="share"><p>{PROSE}</p></section></main>'
    assert html_text.main_text(page) == f"T\n\n{PROSE}"


def test_time_grows_with_the_page_not_with_its_depth():
    def seconds(page):
        began = time.perf_counter()
        html_text.main_text(page)
        return time.perf_counter() - began

    for make in (lambda n: f"<span><p>{PROSE}</p>" * n, lambda n: "<div><b>" * n + "</i></u>" * n, lambda n: "<li><span>" * n):
        seconds(make(200))
        small, large = min(seconds(make(1500)) for _ in range(3)), min(seconds(make(12_000)) for _ in range(2))
        assert large < 8 * small * 3, (small, large)


def test_many_and_deep_suspects_end():
    for name in ("comment", "widget"):
        assert html_text.main_text(f'<div class="{name}">' * 20_000 + PROSE) == PROSE
    page = "".join(f'<article><div class="widget"><p>{i} {PROSE}</p></div></article>' for i in range(3000))
    assert html_text.main_text(page).count(PROSE) == 3000


@pytest.mark.parametrize("tag", ["form id='aspnetForm' method='post'", "fieldset", "dialog open", "aside", "div role='form'", "form><fieldset"])
def test_a_tag_around_the_page_does_not_lose_it(tag):
    small = f"<form><label>Find <b>words</b></label><input name='q'><select><option>all</select><button>Go</button><p>{PROSE}</p></form>"
    for title in ("", "<h1>Title</h1>"):
        for inner in ("<div>{}</div>", "<article>{}</article>", "<main>{}</main>", "{}"):
            text = "".join(f"<p>{i} {PROSE}</p>" for i in range(4))
            got = html_text.main_text(f"<body>{title}<{tag}>{inner.format(text)}<aside>{PROSE}</aside>{small}</{tag.split()[0]}></body>")
            assert [x for x in got.split("\n\n") if x != "Title"] == [f"{i} {PROSE}" for i in range(4)], (title, inner)


def test_short_text_of_a_form_page():
    assert html_text.main_text("<body><form><label>Name</label><h1>Title</h1><p>Short.</p><button>Go</button></form></body>") == "Title\n\nShort."
    assert html_text.main_text("<h1>Title</h1><form><label>Name</label><p>Short.</p></form>") == "Title\n\nShort."
    assert html_text.main_text("<body><form><label>Find</label><input><button>Go</button></form></body>") == ""


def test_scoring_finds_the_container_without_semantic_tags():
    links = "".join(f'<a href="{i}">Link, number {i}, of a long list of links</a> ' for i in range(30))
    page = f"<body><div><div>{links}</div><div><p>{PROSE}</p><p>{PROSE}</p><p>tail</p></div></div></body>"
    assert html_text.main_text(page) == f"{PROSE}\n\n{PROSE}\n\ntail"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), (" \n", ""), ("plain  text", "plain text"), ("<p>hi", "hi"), ("<script>x", ""),
        ("<p>a<p>b</i></p>c", "a\n\nb\n\nc"), ("a < b <", "a < b <"), ("<div " * 3, ""), ("<body><nav>only menu</nav></body>", ""),
    ],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_long_and_deep_pages_end():
    assert html_text.main_text("<div>" * 50_000 + PROSE) == PROSE
    assert html_text.main_text(f"<p>{PROSE}</p>" * 5000).count("\n\n") == 4999


def test_given_pages_match_a_plain_reading(spark):
    """The given pages have one article each; a plain regular-expression reading of it is the brute force."""
    from html import unescape

    for r in queries.op3_html_text(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
        assert r["text"] == "\n\n".join(x for x in blocks if x) and r["n_chars"] == len(r["text"])


def test_page_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>", 3), (None, None, None, 4), (1, "u", "<p>x</p>", 3)], "page_id long, url string, html string, text int")
    assert sorted(map(tuple, html_text.extract_pages(pages).collect()), key=str) == sorted([(1, "u", "x", 1)] * 2 + [(None, None, "", 0)], key=str)
    assert html_text.extract_pages(pages.limit(0)).collect() == []


# ---- archives ----------------------------------------------------------------


def archive(folder, records):
    writer = warc.ArchiveWriter(f"{folder}/archives")
    for r in records:
        writer.add(r)
    name = writer.close()
    path = writer.path
    assert path.endswith(name)
    with pyarrow.fs.LocalFileSystem().open_input_stream(path, compression=None) as f:
        return f.read(), path


def test_stores_that_tasks_cannot_write_to_are_refused_before_the_job(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="wasbs: paths"):
        warc.write_archives(pages, "wasbs://c@a/x")
    assert warc.check_folder("s3a://bucket/x") and warc.check_folder("/x:y/z") and warc.check_folder("file:/x")


@pytest.mark.parametrize("count", [1, 3, 2000])
def test_records_come_back(folder, count):
    records = [warc.make_record(i, f"http://h/{i}?a b", (f"<p>page {i}</p>" * (i % 90)).encode(), None) for i in range(count)]
    data, path = archive(folder, records)
    assert data[:4] == bytes([0x5D, 0x2A, 0x4D, 0x18])
    with pyarrow.fs.LocalFileSystem().open_input_stream(path, compression=None) as f:
        assert list(warc.read_records(f)) == records


def test_damaged_records_are_noticed():
    record = warc.make_record(1, "u", b"payload", None)
    assert warc.parse_record(record)["payload_bytes"] == 7
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload", b"paylaod"))


def test_dictionary_helps(folder):
    data, _ = archive(folder, [warc.make_record(i, "u", f"<html><body><p>{i * 7919}</p></body></html>".encode(), None) for i in range(20_000)])
    import zstandard

    alone = sum(len(zstandard.compress(warc.make_record(i, "u", f"<html><body><p>{i * 7919}</p></body></html>".encode(), None))) for i in range(200))
    assert len(data) / 20_000 < 0.7 * alone / 200


def test_archive_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    rows = [(i, f"http://x/{i}", "<p>same</p>" if i % 3 else f"<p>{i}é</p>" * 20) for i in range(200)]
    rows += [(500, None, None), (501, "", ""), (5, "u", "<p>same</p>"), (198, "again", "<p>198é</p>" * 20)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, keep_id int")
    folder = scratch_dir(spark, "warc")
    archives = warc.write_archives(pages, folder)
    assert archives.selectExpr("sum(records)").first()[0] == len(rows)
    found = warc.read_archives(archives, folder)
    con = duckdb.connect()
    con.register("p", pages.toPandas())
    assert oracle.compare([tuple(r) for r in found.collect()], found.columns, pipeline_sql.warc_sql("p"), con) is None
    empty = warc.write_archives(pages.limit(0), folder)
    assert warc.read_archives(empty, folder).collect() == []
    nulls = warc.write_archives(spark.createDataFrame([(None, None, "a")] * 2, "page_id long, url string, html string"), folder)
    assert {(r["page_id"], r["record_type"]) for r in warc.read_archives(nulls, folder).collect()} == {(None, "response")}


# ---- secrets -----------------------------------------------------------------

BASE = {
    "assign": (r"(?:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A, lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24),
}


def base_spans(text):
    found = []
    for order, (kind, (pattern, flags, good)) in enumerate(BASE.items()):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, flags) if good(m)]
    return [x for _, _, x in sorted(found)]


def test_base_spans_match_plain_patterns():
    rng, automaton = random.Random(2), secret_scan._automaton()
    pieces = [
        "password", "PASSWD", "Secret", "token", "api_key", "apikey", "API_KEY", "=", ": ", "  = ", '"', "'", "abc", "abcdef1",
        "AKIA", "A" * 16, "AKIA" + "B7" * 9, "akia", "0123456789abcdef" * 2, "deadbeef", "g", " ", "\n", "İ", "ſ", "K", "é", "token=token=",
    ]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        mine = [x for x in secret_scan.spans_text(secret_scan.scan(text, automaton)).split(",") if x.split(":")[0] in BASE]
        assert mine == base_spans(text), text


def test_checksums_decide():
    automaton, body = secret_scan._automaton(), "".join(random.Random(1).choices(string.ascii_letters + string.digits, k=30))
    good = f"npm_{body}{secret_scan.crc_base62(body)}"
    assert secret_scan.spans_text(secret_scan.scan(f"x {good} y", automaton)) == f"package_token:2:{2 + len(good)}"
    assert secret_scan.scan(f"x npm_{body}{secret_scan.crc_base62(body + 'x')} y", automaton) == []
    head = "eyJhbGciOiJIUzI1NiJ9"
    assert secret_scan.scan(f"{head}.abcdefghij.{'s' * 20}", automaton)
    assert secret_scan.scan(f"eyJhbGci0iJIUzI1NiJ9.abcdefghij.{'s' * 20}", automaton) == []
    assert secret_scan.redact(f"my {good}, token=abcdefg") == "my [package_token], [assign]"
    assert secret_scan.redact(None) is None


HEADERS = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B2C3D\n\n"
KEY = "MIIEow/IBAAKCAQEA+z\nnrQ9==\n"


@pytest.mark.parametrize(
    ("kind", "body"),
    [
        ("RSA PRIVATE KEY", f"\n{KEY}"), ("PRIVATE KEY", f"\r\n{KEY}"), ("RSA PRIVATE KEY", f"\n{HEADERS}{KEY}"),
        ("RSA PRIVATE KEY", f" {' '.join(HEADERS.split(chr(10)))} {KEY}"), ("PGP PRIVATE KEY BLOCK", f"\n\n{KEY}=aB1/\n"),
        ("PGP PRIVATE KEY BLOCK", f"\nVersion: GnuPG v2.0 (\\Linux)\nComment: a, b - c\n\n{KEY}=aB1/\n"),
    ],
)
def test_forms_of_private_keys(kind, body):
    key = f"-----BEGIN {kind}-----{body}-----END {kind}-----"
    for form in (key, key.replace("\n", "\\n"), key.replace("\n", "\\\\n"), key.replace("\n", "\\\n"), key.replace("\r\n", "\n").replace("\n", "\\r\\n")):
        if form != key and "\\Linux" in key:
            form = form.replace("\\Linux", "Linux")
        text = f'{{"k": "{form}"}} {form}'
        assert secret_scan.redact(text) == '{"k": "[private_key]"} [private_key]', form


def test_no_private_keys():
    for text in (
        "-----BEGIN PUBLIC KEY-----\nMIIE\n-----END PUBLIC KEY-----", "-----BEGIN PRIVATE KEY----------END PRIVATE KEY-----",
        "-----BEGIN PRIVATE KEY-----\nsee: the manual\nwith words, and so on\n-----END PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----\nMIIE",
        "-----BEGIN PRIVATE KEY-----" * 20_000, "-----BEGIN PRIVATE KEY-----" + "\\" * 100_000, "-----BEGIN PRIVATE KEY-----" + "a: b\n" * 100_000,
    ):
        assert secret_scan.redact(text) == text


def test_secret_rows(spark, make_docs):
    docs = make_docs([(1, "token: abcdefgh"), (1, "token: abcdefgh"), (2, None), (None, ""), (3, "w " * 200_000 + "secret=abcdef")], ("spans",))
    found = {r["doc_id"]: (r["n_assign"], r["spans"]) for r in secret_scan.secret_spans(docs).collect()}
    assert found == {1: (1, "assign:0:15"), 2: (0, ""), None: (0, ""), 3: (1, "assign:400000:400013")}
    for r in queries.op8_secret_scan(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect():
        want = base_spans(r["text"])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x.startswith(k) for x in want) for k in BASE)


# ---- languages and toxicity ----------------------------------------------------


def test_grams_match_a_plain_reading():
    for text in ["Ab, c!", "", "...", "x", "Straße  naïve", "你好 世", "a" * 20]:
        words = re.findall(r"[^\W_]+", text.lower())
        plain = [w2[i : i + n] for n in (1, 2, 3) for w in words for w2 in [f"\0{w}\0"] for i in range(len(w2) - n + 1) if w2[i : i + n] != "\0"]
        buckets, owners, count = ngrams.grams(text, 1, 3, 30)
        assert len(buckets) == len(plain) and len(set(buckets)) == len(set(plain)) and count == len(words)
        if words:
            assert set(owners) == set(range(count))


def test_mixture_proportions():
    rng = np.random.default_rng(0)
    logs = np.log(rng.dirichlet(np.full(500, 0.05), 3) + 1e-6)
    counts = rng.multinomial(3000, 0.7 * np.exp(logs[0]) / np.exp(logs[0]).sum() + 0.3 * np.exp(logs[2]) / np.exp(logs[2]).sum())
    mix, _ = langid.proportions(logs, counts.astype(float), 50)
    assert abs(mix[0] - 0.7) < 0.05 and abs(mix[2] - 0.3) < 0.05


def test_held_out_languages(spark):
    rows = queries.op9_langid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    tested = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in tested]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_languages(make_docs):
    docs = make_docs([(i, "the cat sat on the mat and then it ran", "en", "s") for i in range(30)] + [(i, "le chat est sur la table avec nous", "fr", "s") for i in range(30, 60)] + [(60, None, None, None), (61, "123 ...", "en", "s"), (None, "le chat est", None, None)], ("score", "languages"))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.language_of(docs).collect()}
    assert found[60] == found[61] == ("und", 0.0) and found[None][0] == "fr" and found[0][0] == "en"
    assert [r["lang_pred"] for r in langid.language_of(make_docs([(1, "some text", None, None)])).collect()] == ["und"]
    assert langid.language_of(docs.limit(0)).collect() == []


def test_long_texts_are_learned_from_where_short_ones_are_few(spark, make_docs):
    cat, chat = "the cat sat on the mat and then it ran ", "le chat est sur la table avec nous "
    docs = make_docs([(i, cat, "en", "s") for i in range(30)] + [(i, chat * 700, "fr", "s") for i in range(30, 36)] + [(99, chat, None, None)])
    assert {r["doc_id"]: r["lang_pred"] for r in langid.language_of(docs).collect()}[99] == "fr"
    clean, bad = ["good day to you all", "what a nice garden"], "you stupid moron there "
    rows = [(i, clean[i % 2]) for i in range(40)] + [(i, bad * 400) for i in range(40, 60)]
    labels = spark.createDataFrame([(i, int(i >= 40)) for i in range(60)], "doc_id long, toxic int")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(make_docs([*rows, (99, bad)]), labels).collect()}
    assert found[99] == 1 and found[0] == found[1] == 0


def test_samples_are_filled_up_and_bounded(make_docs):
    rows = [(i, "x" * size, lang, "s") for i, (size, lang) in enumerate([(0, "a"), (9, "a"), (12, "a"), (30, "a"), (5, "a"), (50, "b"), (40, "b")] * 20)]
    docs = make_docs([*rows, *((1000 + i, None, "a", "s") for i in range(50))])
    ids = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5}

    def sizes(**bounds):
        found = langid.training_sample(docs, chars=10, **bounds).collect()
        return {x: sorted(len(r["text"]) for r in found if r["lang"] == x) for x in "ab"}

    usable = sorted(len(t) for i, t, lang, _ in rows if i in ids and lang == "a" and t)
    short = sum(x <= 10 for x in usable)
    assert sizes(rows=short, total=0)["a"] == usable[:short]
    assert sizes(rows=10**6, total=10**6)["a"] == usable
    assert sizes(rows=short + 2, total=10**6)["a"] == usable[: short + 2]
    assert sizes(rows=5, total=85)["b"] == [40, 40] and sizes(rows=5, total=25)["b"] == [25]
    with pytest.raises(ValueError):
        langid.training_sample(docs, languages=1)


def test_unseen_spellings_are_toxic(spark, make_docs):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdehilnorstu", k=rng.randrange(2, 9))) for _ in range(300)]
    bad = ["scumbag", "worthless", "disgusting"]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(vocabulary, k=rng.randrange(20, 120))
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, i % 4 == 0, 7))
    rows += [(1000, "scumbags " + rows[1][1]), (1001, "wortthless " + rows[2][1]), (1002, rows[1][1] + " " + rows[2][1]), (1003, None), (1004, "...")]
    labels = spark.createDataFrame([(i, int(t), q) for i, t, q in labels] + [(5, None, 1), (None, 1, 1)], "doc_id long, toxic int, score int")
    found = {r["doc_id"]: r for r in toxicity.toxicity(make_docs(rows, ("score",)), labels).collect()}
    assert [found[i]["predicted"] for i in (1000, 1001, 1002, 1003, 1004)] == [1, 1, 0, 0, 0]
    tested = [found[i] for i in range(400) if found[i]["held_out"]]
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in tested]) > 0.95
    none = toxicity.toxicity(make_docs(rows[:3]), labels.limit(0)).collect()
    assert len(none) == 3 and all(0 <= r["score"] <= 1 for r in none)


def test_folded_scores_equal_the_network():
    model = toxicity.fit(["good day to you all", "you stupid moron there"] * 8, [0, 1] * 8, epochs=3)
    text = "such a stupid day it is"
    buckets, owners, count = ngrams.grams(text, toxicity.LOW, toxicity.HIGH, toxicity.BITS)
    words = np.array([model.vectors[buckets[owners == i]].mean(axis=0) for i in range(count)])
    passages = np.array([words[i : i + toxicity.WINDOW].mean(axis=0) for i in range(count - toxicity.WINDOW + 1)])
    inputs = passages @ model.weights.T + np.array([0.0, model.bias])
    softmax = np.exp(inputs) / np.exp(inputs).sum(axis=1, keepdims=True)
    folded = toxicity.passages(toxicity.word_means(model.bucket_scores(), text)) + model.bias
    assert np.allclose(softmax[:, 1], 1 / (1 + np.exp(-folded)), atol=1e-5)


def test_long_texts_in_pieces_are_the_same(monkeypatch):
    rng = random.Random(8)
    letters = "abcXYZéßΣσ語々。、 \n\t\u3000-"
    text = "".join(rng.choice(letters) for _ in range(5000)) + "ΟΔΟΣ " * 40
    scores = np.random.default_rng(1).normal(size=1 << toxicity.BITS)
    whole, means = langid.bag(text), toxicity.word_means(scores, text)
    for size in (1, 7, 100, 4999):
        monkeypatch.setattr(ngrams, "PIECE", size)
        assert "".join(ngrams.pieces(text)) == text
        again = langid.bag(text)
        assert np.array_equal(whole[0], again[0]) and np.array_equal(whole[1], again[1])
        assert np.allclose(means, toxicity.word_means(scores, text))


def test_letters_among_the_punctuation_of_scripts():
    for text in ("々", "〆", "〇々"):
        assert len(langid.bag(text)[0]), text
    names, logs = langid.fit(["ab cd", "々 〆"], ["a", "j"])
    assert langid.predict("々", names, logs)[0] == "j" and langid.predict("。、", names, logs)[0] == "und"


def test_the_sample_does_not_depend_on_how_it_is_cut(spark):
    """Sizes around the limits, against a plain ranking."""
    import collections

    rng = random.Random(3)
    rows = [(i, g, rng.choice([5, 9, 10, 11, 40, 90])) for i in range(400) for g in (["a"] if i % 7 else ["a", "b"])] + [(1000, "c", 500)]
    known = spark.createDataFrame(rows, "doc_id long, g string, size int")
    hashed = {r.doc_id: r.h for r in known.selectExpr("doc_id", "xxhash64(doc_id) AS h").distinct().collect()}
    for most, chars, total in ((20, 10, 1000), (500, 10, 3000), (30, 4, 200)):
        want = set()
        groups = collections.defaultdict(list)
        for i, g, size in rows:
            groups[g].append((size if size > chars else 0, hashed[i], i, size))
        for g, found in groups.items():
            so_far = 0
            for place, (_, _, i, size) in enumerate(sorted(found)[:most], 1):
                so_far += size
                if size <= chars or place == 1 or so_far <= total:
                    want.add((i, g, size))
        assert {tuple(r) for r in toxicity.choose(known, "g", most, chars, total).collect()} == want
