import base64
import hashlib
import html as entities
import io
import re
import zipfile

import pytest

from cartledger.llm import html, queries, warc

PAGES = "page_id long, url string, html string, text string, n_chars int, K0 int"
STORY = "<p>Long enough words of a story that goes on for a while, and then some more.</p>"


def awkward_pages(spark):
    rows = [
        (1, "http://a", f"<body><nav><a href=/>Home</a></nav><article><h1>Head</h1>{STORY}<div class='ad'>buy now</div><p>The end.</p></article><footer>&copy; us</footer>", "t", 1, 1),
        (2, None, None, None, None, None),
        (3, "http://b", "", "", 0, 0),
        (4, "http://b", "plain &amp; simple &lt;text&gt;   here", "", 0, 0),
        (None, None, "<p>null id</p>", "", 0, 0),
        (5, "http://c", "<p>same</p>", "", 0, 0),
        (6, "http://c", "<p>same</p>", "", 0, 0),
        (6, "http://c", "<p>same</p>", "", 0, 0),
        (7, "x\r\ny", "<p>" + "long é " * 50_000, "", 0, 0),
        (8, "http://d", "<p>null id</p>", "", 0, 0),
    ]
    return spark.createDataFrame(rows, PAGES)


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return html.learn(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_marked_articles_are_found_whole(spark, sf_dir):
    """Of pages that mark their article, its text and nothing else."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op3_html(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        plain = re.sub("<[^>]*>", "", re.sub("</?(h1|p|br)>", " ", inside))
        assert r.text == " ".join(entities.unescape(plain).split())
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div id=menu>Home News Sport</div><div class='content'><h1>T</h1>{STORY}</div><div class='comments'><p>I say a lot of things here, as readers do, again and again.</p></div>",
         "T Long enough words of a story that goes on for a while, and then some more."),
        (f"<main><aside>side words</aside>{STORY}<form>name <input><button>go</button></form></main><script>var p='<p>no</p>'</script>",
         "Long enough words of a story that goes on for a while, and then some more."),
        ("<article>foo<b>bar</b> baz<br>q&eacute;&#x41;<!-- no --> end</article>", "foobar baz qéA end"),
        ("<p>open <b>tags &am", "open tags &am"),
        ("<!-- never closed <p>x", ""),
        ("<style>p{}", ""),
        ("a < b and c > d", "a < b and c > d"),
        ("", ""),
    ],
)
def test_plain_cases(weights, page, text):
    assert html.main_text(page, *weights) == text


@pytest.mark.parametrize(
    "opening",
    [
        "<article class='post no-sidebar'>", "<article class='hentry tag-search'>", "<div class='content has-sidebar'>",
        "<article data-id='ad-12'>", "<article id=ad-12>", "<div class='entry-content related-posts-on'>",
        "<article title=\"a class='ad'\">", "<div class=has-sidebar>",
    ],
)
def test_names_beside_the_article_do_not_lose_it(weights, opening):
    close = f"</{opening[1:].split()[0]}>"
    text = "Long enough words of a story that goes on for a while, and then some more."
    page = f"<nav>Home News</nav>{opening}{STORY}{close}<div class=post-comments><article class=comment-body><p>I say.</p></article></div>"
    assert html.main_text(page, *weights) == text


ARTICLE = "Long enough words of a story that goes on for a while, and then some more."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<header><form><datalist><option value=a>A<option value=b>B</datalist></form></header><article>{STORY}</article>", ARTICLE),
        (f"<header><form><datalist><option value=a><option value=b></datalist></form></header><article>{STORY}</article><select><option>z</option></select>", ARTICLE),
        *((f"<header><{tag}>other</header><article>{STORY}</article>", ARTICLE)
          for tag in ("object", "svg", "video", "audio", "canvas", "math", "noscript", "template", "select")),
        *((f"<header>menu</header><{tag}><article>{STORY}</article>", ARTICLE) for tag in ("object", "svg", "video", "canvas")),
        *((f"<article><p>one two <{tag}><g class=content><article>no</article></g></{tag}> three</p>{STORY}</article>", f"one two three {ARTICLE}")
          for tag in ("object", "svg", "video", "audio", "canvas", "noscript", "template", "select")),
        (f"<article><svg><path d=M0>{STORY}</article>", ARTICLE),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>", "so x=2 holds"),
        (f"<article>{STORY}</article><textarea>never closed <article>no</article>", ARTICLE),
        (f"<article>{STORY}<svg>{'<path/>' * 99}</svg>{STORY}</article>", f"{ARTICLE} {ARTICLE}"),
    ],
)
def test_unclosed_elements_do_not_swallow_the_page(weights, page, text):
    assert html.main_text(page, *weights) == text


def test_labelled_pages_overrule_the_fixed_names(spark):
    """Where articles stand in a form and a promo, though not where they hold one."""
    page = f"<form><article class=promo>{STORY}<div class=ad>{'buy ' * 9}</div></article><footer>{'us ' * 9}</footer></form>"
    rows = spark.createDataFrame([(i, "u", page, "", 0, 0) for i in range(60)], PAGES)
    learned = html.learn(rows)
    assert learned[0]["form"] > -html.TELLS and learned[0]["promo"] > -html.TELLS
    assert learned[0]["ad"] <= -html.TELLS and learned[0]["footer"] <= -html.TELLS
    text = "Long enough words of a story that goes on for a while, and then some more."
    assert {r.text for r in html.extract(rows).collect()} == {text}


def test_hostile_markup_is_linear(weights):
    for page in ("<a b='" * 20_000, "<" * 200_000, "<div>" * 50_000 + "x", "<!--" * 50_000, "&amp" * 50_000):
        html.main_text(page, *weights)


def test_awkward_pages(spark, tmp_path):
    pages = awkward_pages(spark)
    rows = html.extract(pages).collect()
    assert sorted(str(r.page_id) for r in rows) == sorted(str(r.page_id) for r in pages.collect())
    texts = {r.page_id: r.text for r in rows}
    assert texts[1] == "Head Long enough words of a story that goes on for a while, and then some more. The end."
    assert texts[2] == texts[3] == ""
    assert texts[4] == "plain & simple <text> here"
    assert len(texts[7]) == 7 * 50_000 - 1
    assert html.extract(pages.limit(0)).collect() == []


def want_records(rows, least=0):
    largest = {}
    payload = lambda r: (r.html or "").encode()
    for r in rows:
        if r.page_id is not None and len(payload(r)) >= least:
            largest[payload(r)] = max(largest.get(payload(r), r.page_id), r.page_id)
    out, seen = [], set()
    for r in rows:
        p = payload(r)
        refers = largest.get(p) if len(p) >= least else None
        if refers == r.page_id and p not in seen:  # one response a payload
            seen.add(p)
            refers = None
        sha = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((r.page_id, len(p), sha, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_round_trip(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = queries.op8_warc(spark, sf_dir)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=str) == want_records(rows)


@pytest.mark.parametrize("least", [0, 12])
def test_awkward_round_trip(spark, least):
    pages = awkward_pages(spark)
    got = warc.archived(spark, pages, min_bytes=least).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == want_records(pages.collect(), least)
    full = {r.page_id: (r.html or "").encode() for r in pages.collect() if r.page_id}
    assert all(bytes(r.payload) == full[r.page_id] for r in got if r.page_id and r.record_type == "response")
    assert warc.archived(spark, pages.limit(0)).collect() == []


def test_packages_are_valid_zip_files(spark, sf_dir, tmp_path, monkeypatch):
    """Several to a task, whole for another reader, and read back as written."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(40)
    monkeypatch.setattr(warc, "PACKAGE_BYTES", 5_000)
    folder = (tmp_path / "out").as_uri()
    packages = warc.write_archives(pages, folder)
    listed = packages.collect()
    assert len(listed) > 3 and sum(r.records for r in listed) == 40
    for r in listed:
        with zipfile.ZipFile(r.path) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {0}
    assert warc.read_archives(packages, folder).count() == 40


@pytest.mark.parametrize("comment", [b"", b"x" * 500])
def test_directories_also_in_zip64_form(comment):
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        for name in ("a", "dir/b"):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=True) as m:
                m.write(name.encode() * 10)
        z.comment = comment
    data = plain.getvalue()
    found = warc.members(io.BytesIO(data), len(data))
    assert [(m.name, m.method, m.size) for m in found] == [("a", 0, 10), ("dir/b", 0, 50)]
    at = warc.data_offset(io.BytesIO(data), found[1])
    assert data[at : at + 50] == b"dir/b" * 10
    # The same directory with its place and sizes only in the 64-bit records.
    end = data.rfind(b"PK\x05\x06")
    start = int.from_bytes(data[end + 16 : end + 20], "little")
    length = int.from_bytes(data[end + 12 : end + 16], "little")
    import struct

    big = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 2, 2, length, start)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1)
    tail = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    wide = data[:end] + big + locator + tail
    assert warc.members(io.BytesIO(wide), len(wide)) == found


def test_damage_is_noticed():
    record = warc.record(1, "http://a", b"payload", None)
    assert warc.parse(record).payload == b"payload"
    with pytest.raises(ValueError):
        warc.parse(record.replace(b"payload\r\n", b"pAyload\r\n"))
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(b"nothing here"), 12)


def test_one_response_of_repeated_pages(spark):
    rows = [(7, "u", "same")] * 50 + [(3, "u", "same"), (7, "v", "same"), (7, "u", "other"), (8, "w", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = warc.archived(spark, pages).collect()
    want = want_records(spark.createDataFrame(rows, pages.schema).collect())
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == want
    assert [r[3] for r in want].count("response") == 2


def test_a_task_that_runs_twice_loses_nothing(tmp_path, monkeypatch):
    """Two attempts at one partition, in different order, the second one cut off."""
    monkeypatch.setattr(warc, "PACKAGE_BYTES", 600)
    rows = [(i, warc.record(i, "http://a", bytes([65 + i]) * 400, None)) for i in range(8)]
    folder = tmp_path.as_uri()
    winner = [r[0] for r in warc._packages(folder, "000000", "11", iter(rows))]
    next(warc._packages(folder, "000000", "12", iter(rows[::-1])))
    found = []
    for path in winner:
        with open(path, "rb") as f:
            for offset, length, _ in warc._ranges(path, warc.fs.LocalFileSystem()):
                found += [warc.parse(r).page_id for r in warc._unpacked(warc._at(f, offset, length))]
    assert len(winner) > 1 and sorted(found) == list(range(8))


class Hadoop:
    """Stands in for a session whose default file system is given."""

    def __init__(self, default):
        self.sparkContext = self._jsc = self
        self.default = default

    def hadoopConfiguration(self):
        return self

    def get(self, name):
        return self.default


def test_folders_without_scheme_lie_in_the_default_file_system():
    assert warc.with_scheme(Hadoop("hdfs://nn:8020"), "/shared/run") == "hdfs://nn:8020/shared/run"
    assert warc.with_scheme(Hadoop("file:///"), "/shared/run") == "file:///shared/run"
    assert warc.with_scheme(Hadoop(None), "/shared/run") == "file:///shared/run"
    for folder in ("s3a://b/run", "file:/run", "file:///run"):
        assert warc.with_scheme(Hadoop("hdfs://nn"), folder) == folder


@pytest.fixture(scope="module")
def weights(spark):
    return html.learn(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_other_matter_takes_nothing_from_an_article(weights):
    advert = f"<div class='advert'>{words('buy', 60)}</div>"
    related = "<ul class='related'>" + "".join(f"<li><a href=x>{words('more', 8)}</a></li>" for _ in range(10)) + "</ul>"
    nav = "<nav><a href=a>home</a> <a href=b>news</a></nav>"
    for other in (advert, related):
        page = f"<body>{nav}<article><p>{words('a', 20)}</p>{other}<p>{words('z', 15)}</p></article></body>"
        assert html.main_text(page, *weights) == f"{words('a', 20)} {words('z', 15)}"
        page = f"<body>{nav}<article><p>short lead</p>{other}<p>{words('z', 40)}</p></article></body>"
        assert html.main_text(page, *weights) == f"short lead {words('z', 40)}"


def test_tables_and_links_belong_to_the_article(weights):
    table = "<table>" + "".join(f"<tr><td>k{i}</td><td>v{i}</td></tr>" for i in range(20)) + "</table>"
    page = f"<body><div><p>{words('a', 30)}</p>{table}<p>{words('z', 12)}</p></div></body>"
    cells = " ".join(f"k{i} v{i}" for i in range(20))
    assert html.main_text(page, *weights) == f"{words('a', 30)} {cells} {words('z', 12)}"
    page = f"<body><article><p><a href=x>{words('a', 30)}</a></p></article></body>"
    assert html.main_text(page, *weights) == words("a", 30)


def test_the_header_of_content_is_its_headline(weights):
    page = f"<body><div class='post'><header class='post-header'><h1>Head line</h1></header><p>{words('a', 30)}</p></div></body>"
    assert html.main_text(page, *weights) == f"Head line {words('a', 30)}"


def test_attributes_of_any_length(weights):
    long = "> LEAK words " * 8_000
    page = f"<body><article><p>{words('a', 9)}</p><img alt=\"{long}\"><p data-x='{long}'>{words('z', 9)}</p></article></body>"
    assert html.main_text(page, *weights) == f"{words('a', 9)} {words('z', 9)}"
    page = "<article><p title=\"never closed>one two</p><p title='nor this>three four</p>" + "<b x=>y</b> " * 30_000 + "</article>"
    assert html.main_text(page, *weights).startswith("one two three four")
