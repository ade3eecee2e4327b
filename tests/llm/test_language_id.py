import time

import pytest

from ledgerloom.llm.language_id import address_of, declared_language, language_posteriors, page_text
from llm.texts import long_text


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", 0.5) for row in rows], "page_id bigint, url string, html string, lang string, probability double")


EN, DE = "the cat and the dog are in the house with the bird ", "der hund und die katze sind mit dem vogel in dem haus "


@pytest.fixture(scope="module")
def known(docs):
    return docs([EN * 20, DE * 20, None, "x"], langs={0: "en", 1: "de"})


def test_accuracy_on_pages(spark):
    """Addresses of the given pages hold the language, which the method does not read."""
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/pages.parquet")
    rows = language_posteriors(table, spark.read.parquet(f"{folder}/documents.parquet")).join(
        table.selectExpr("page_id", "regexp_extract(url, '/(en|de|fr|es)/', 1) as truth"), "page_id").where("truth <> ''").collect()
    assert len(rows) > 100 and sum(row["lang"] == row["truth"] for row in rows) >= 0.98 * len(rows)


def test_held_out_documents(spark):
    """Trained on one half of the documents, the text alone tells the language of the other half."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    other = table.where("doc_id % 2 = 1").selectExpr("doc_id as page_id", "cast(null as string) as url", "text as html", "lang as truth")
    rows = language_posteriors(other, table.where("doc_id % 2 = 0")).join(other.select("page_id", "truth"), "page_id").collect()
    assert sum(row["lang"] == row["truth"] for row in rows) >= 0.97 * len(rows)


def test_evidence_decides_where_text_does_not(spark, known):
    rows = [(i, f"http://a{i}.example.de/x", f'<html lang="de">{DE * 3}') for i in range(20)]
    rows += [(100 + i, f"http://b{i}.example.org/x", f'<html lang="en">{EN * 3}') for i in range(20)]
    rows += [(200, "http://q.other.de/", "<html lang=de></html>"), (201, "http://b1.example.org/y", "<p> </p>"), (202, None, None)]
    found = {row["page_id"]: row for row in language_posteriors(pages(spark, rows), known).collect()}
    assert all(found[i]["lang"] == "de" and found[100 + i]["lang"] == "en" for i in range(20))
    assert found[200]["lang"] == "de" and found[200]["text_lang"] is None and found[200]["probability"] > 0.9
    assert found[201]["lang"] == "en" and found[201]["probability"] > 0.6
    # equal evidence: the first language, at one half
    assert found[202]["lang"] == "de" and found[202]["probability"] == pytest.approx(0.5)


def test_hosts_lean_on_their_domain(spark, known):
    rows = [(i, f"http://h{i}.shop.net/", EN) for i in range(10)] + [(20, "http://new.shop.net/", ""), (21, "http://new.site.net/", "")]
    found = {row["page_id"]: row["probability"] for row in language_posteriors(pages(spark, rows), known).where("lang = 'en'").collect()}
    assert found[20] > found[21]


def test_edge_tables(spark, known, docs):
    assert language_posteriors(pages(spark, []), known).count() == 0
    rows = [(1, "http://[bad", EN), (1, "", EN + long_text(20_000)), (None, "mailto:x@y", f"<script>{DE * 9}</script>{EN}")]
    found = language_posteriors(pages(spark, rows), known).collect()
    assert [row["host"] for row in found] == [None] * 3 and sorted(str(row["page_id"]) for row in found) == ["1", "1", "None"]
    none = language_posteriors(pages(spark, rows), docs([])).collect()
    assert [row["lang"] for row in none] == [None] * 3


def test_parts_of_pages():
    assert address_of("https://User@WWW.Example.co.uk:8080/a?b#c") == ("www.example.co.uk", "co.uk", "uk")
    assert address_of(None) == address_of("no address") == (None, None, None)
    assert page_text("<p>a&amp;b<!-- <p>no --><style>x</style ><script>\nno</script>c").split() == ["a&b", "c"]


def test_declared_language_is_that_of_the_first_page_tag():
    assert declared_language('<!doctype html><HTML class=x xml:LANG = "De-AT">') == "de"
    assert declared_language("<htmlx lang=fr><html lang=\"\"><p lang=en>") is None
    assert declared_language("<html data=1 lang='  en") == "en"
    assert declared_language("") is None


@pytest.mark.parametrize("part", ["<html ", "<script>", "<style ", "<!--", "<", "</script ", "<!-- --", "<html lang= ", "&#", "9", " ", "<html lang='",
                                  "<script></script "])
def test_hostile_markup_takes_time_in_step_with_its_length(part):
    page = part * (10_000_000 // len(part))
    for markup in (page, "<html lang= " + page, "&#" + page + ";"):
        start = time.process_time()
        page_text(markup)
        declared_language(markup)
        assert time.process_time() - start < 4


def test_references_take_time_in_step_with_their_number():
    start = time.process_time()
    assert page_text("&#65;" * 400_000) == "A" * 400_000
    assert page_text("&#0000000000065" * 400_000) == "A" * 400_000
    assert time.process_time() - start < 8


def test_unclosed_and_nested_markup():
    assert page_text("a<script>b<p>c").split() == ["a", "b", "c"]
    assert page_text("a<!-- b<p>c").split() == ["a", "c"]
    assert page_text("a<!-->b-->c<STYLE>x</Style >d<scripts>e < f").split() == ["a", "c", "d", "e", "<", "f"]
    assert page_text("&#" + "9" * 9000 + ";&#0000065;&#x42;") == "\ufffdAB"
