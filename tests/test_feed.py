import gzip
import io

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scriptorium.sources import atom, feed

ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
  <title type="html">Query</title>
  <id>http://arxiv.org/api/x</id>
  <updated>2024-05-05T00:00:00-04:00</updated>
  <opensearch:totalResults xmlns:opensearch="http://a9.com/-/spec/opensearch/1.1/">2</opensearch:totalResults>
  <entry>
    <id>http://arxiv.org/abs/2405.00001v1</id>
    <updated>2024-05-02T00:00:00Z</updated>
    <published>2024-05-01T00:00:00Z</published>
    <title>A title &amp; more
  on a second line</title>
    <summary type="text">
      Größe 中文 &lt;b&gt;
    </summary>
    <author><name> Ann One </name><arxiv:affiliation>X</arxiv:affiliation></author>
    <author><name>Bob</name></author>
    <author></author>
    <arxiv:primary_category term="cs.AI" scheme="s"/>
    <category term="cs.AI" scheme="s"/>
    <category term="stat.ML" scheme="s"/>
  </entry>
  <entry>
    <id>http://arxiv.org/abs/2405.00002v1</id>
    <title></title>
    <category term="math.CO"/>
  </entry>
</feed>
"""


@pytest.fixture
def landed(tmp_path):
    (tmp_path / "page0.xml").write_text(ATOM, encoding="utf-8")
    return str(tmp_path)


def test_atom_to_bronze(spark, landed):
    rows = feed.to_bronze(feed.read_feed(spark, landed), "2026-01-02", "run")
    first, second = rows.orderBy("url").collect()
    assert first.asDict() == {
        "source": "arxiv",
        "url": "http://arxiv.org/abs/2405.00001v1",
        "title": "A title & more\n  on a second line",
        "content": "Größe 中文 <b>",
        "authors": ["Ann One", "Bob", ""],
        "published_at": "2024-05-01T00:00:00Z",
        "updated_at": "2024-05-02T00:00:00Z",
        "process_date": "2026-01-02",
        "run_id": "run",
    }
    assert (second.title, second.content, second.published_at, second.authors) == ("", "", "", [])


def test_categories(spark, landed):
    entries = feed.read_feed(spark, landed)
    assert [r.id[-7:] for r in feed.in_categories(entries).collect()] == ["00001v1"]
    assert feed.in_categories(entries, ["stat.ML", "math.CO"]).count() == 2


PREFIXED = """<?xml version="1.0" encoding="iso-8859-1"?>
<a:feed xmlns:a="http://www.w3.org/2005/Atom" xmlns="urn:other">
  <entry><a:id>not an entry of the feed</a:id></entry>
  <a:entry>
    <a:id> u1 </a:id><title>of another kind</title><a:title>caf\xe9 <b>cut</b> here</a:title>
    <a:author><a:name>Ann</a:name></a:author><author><a:name>no author</a:name></author>
    <a:category term="cs.AI"/><category term="cs.LG"/>
    <a:source><a:entry><a:id>inside</a:id></a:entry></a:source>
  </a:entry>
</a:feed>
"""


def test_names_are_resolved_by_namespace(spark, tmp_path):
    (tmp_path / "prefixed.xml").write_bytes(PREFIXED.encode("latin-1"))
    (row,) = feed.read_feed(spark, str(tmp_path)).collect()
    assert (row.id, row.title, row.summary) == (" u1 ", "caf\xe9 ", None)
    assert ([a.name for a in row.author], [c._term for c in row.category]) == (["Ann"], ["cs.AI"])


BROKEN = {
    "between": ATOM[: ATOM.index("</entry>") + len("</entry>")],
    "inside": ATOM[: ATOM.index("</summary>")],
    "before_the_end": ATOM[: ATOM.rindex("</feed>")],
    "malformed": ATOM.replace("<title></title>", "<title>"),
    "undefined": ATOM.replace("&amp;", "&nothing;"),
    "unbound": ATOM.replace(' xmlns:arxiv="http://arxiv.org/schemas/atom"', ""),
    "followed": ATOM + "<feed/>",
    "empty": "",
    "not_xml": '{"feed": []}',
}


@pytest.mark.parametrize("kind", BROKEN)
@pytest.mark.parametrize("pattern", ["", "/*.xml"])
def test_a_document_that_is_not_whole_fails(spark, landed, tmp_path, kind, pattern):
    if kind == "empty" and pattern:
        pytest.skip("Spark's own file source leaves files without a byte out")
    (tmp_path / "page1.xml").write_text(BROKEN[kind], encoding="utf-8")
    with pytest.raises(PySparkException, match="MALFORMED feed .*page1.xml"):
        feed.read_feed(spark, landed + pattern).collect()


def test_categories_are_skipped_while_parsing(spark, landed):
    for path in (landed, f"{landed}/page*.xml"):
        assert [r.id[-7:] for r in feed.read_feed(spark, path, ["cs.AI", "x"]).collect()] == ["00001v1"]
        assert feed.read_feed(spark, path, []).count() == 0
        assert feed.read_feed(spark, path).count() == 2


def test_a_partition_for_each_shown_file(spark, landed, tmp_path):
    (tmp_path / "_SUCCESS").write_text("")
    with gzip.open(tmp_path / "page1.xml.gz", "wt", encoding="utf-8") as zipped:
        zipped.write(ATOM)
    entries = feed.read_feed(spark, landed)
    assert entries.count() == 4
    assert entries.rdd.getNumPartitions() == 2
    assert feed.read_feed(spark, [f"{landed}/page0.xml", f"file:{landed}"]).count() == 6
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        feed.read_feed(spark, f"{landed}/nothing").collect()


def test_a_large_document_is_parsed_in_blocks(monkeypatch):
    monkeypatch.setattr(atom, "BLOCK", 700)
    many = ATOM.replace("</feed>", "".join(f"<entry><id>{i}</id><summary>{'s' * i}</summary></entry>" for i in range(300)) + "</feed>")
    found = list(atom.entries_of(io.BytesIO(many.encode()), "many"))
    assert [e["id"] for e in found[2:]] == [str(i) for i in range(300)]
    batches = list(atom.batches_of(iter(found)))
    assert len(batches) > 20 and sum(len(b) for b in batches) == 302


def test_a_root_that_is_no_feed_has_no_entries(spark, tmp_path):
    (tmp_path / "page0.xml").write_text('<entry xmlns="http://www.w3.org/2005/Atom"><id>x</id></entry>')
    assert feed.read_feed(spark, str(tmp_path)).count() == 0


def test_feed_without_entries(spark, tmp_path):
    (tmp_path / "page0.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"></feed>')
    assert feed.read_feed(spark, str(tmp_path)).count() == 0


@pytest.fixture(scope="module")
def entries(spark):
    return spark.range(1000).select(
        F.format_string("id-%04d", "id").alias("id"),
        F.format_string("2024-01-%02dT00:00:00Z", F.col("id") % 28 + 1).alias("published"),
        F.array(F.struct(F.when(F.col("id") % 2 == 0, "cs.AI").otherwise("x").alias("_term"))).alias(
            "category"
        ),
    )


def newest():
    ids = [i for i in range(1000) if i % 2 == 0]
    return [f"id-{i:04}" for i in sorted(ids, key=lambda i: (-(i % 28), i))]


@pytest.mark.parametrize("scale", ["smoke", "test", "full"])
def test_window_is_all_pages(entries, scale):
    size = feed.SCALES[scale]
    got = [r.id for r in feed.feed_window(entries, scale).collect()]
    assert got == newest()[: size.rows]
    pages = [feed.feed_page(entries, p, size.page_size) for p in range(size.pages)]
    assert [r.id for page in pages for r in page.collect()] == got


def test_page_past_the_end(entries):
    assert feed.feed_page(entries, 5, 100).count() == 0
    assert feed.feed_page(entries, 4, 120).count() == 20


def test_window_is_top_k(entries, plan):
    text = plan(feed.feed_window(entries, "full"))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


@pytest.mark.parametrize(
    "conf, environ, params, expected",
    [
        (None, {}, None, "full"),
        ({"scale": " Smoke "}, {"SCRIPTORIUM_SCALE": "test"}, {"scale": "full"}, "smoke"),
        ({}, {"SCRIPTORIUM_SCALE": " TEST "}, {"scale": "smoke"}, "test"),
        ({"scale": ""}, {"SCRIPTORIUM_SCALE": " "}, {"scale": "smoke"}, "smoke"),
        ({"scale": "huge"}, {"SCRIPTORIUM_SCALE": "test"}, {}, "full"),
        ({"scale": 5}, {}, {"scale": "test"}, "full"),
        ("smoke", {}, ["test"], "full"),
    ],
)
def test_scale(conf, environ, params, expected):
    assert feed.resolve_scale(conf, params, environ) == expected
