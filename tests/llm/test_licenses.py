from helpers import DOCS, empty, messy

from tomelight.llm import licenses

FILLER = "some other words that no notice holds at all here "


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    return sorted(licenses.scan_documents(df).collect(), key=lambda r: (r.doc_id, r.first_word))


def test_every_template_is_found_where_it_stands(spark):
    names = sorted(licenses.TEMPLATES)
    texts = [FILLER * 3 + licenses.TEMPLATES[n].upper() + " " + FILLER for n in names]
    out = scan(spark, texts)
    found = {(r.doc_id, r.license) for r in out if r.exact}
    for i, name in enumerate(names):
        # A notice that another template begins with is reported by the better one.
        assert (i, name) in found, name
    assert all(r.first_word >= 30 for r in out)


def test_differences_are_told(spark):
    text = licenses.TEMPLATES["mit-text"].replace("free of charge", "for a large fee").replace("publish, ", "")
    (row,) = scan(spark, [FILLER + text])
    assert row.license == "mit-text" and not row.exact and 0.8 <= row.covered < 1
    assert "-publish" in row.differences and "+for a large fee" in row.differences
    assert row.missing == 4 and row.added == 4


def test_neighbours_and_clean_texts(spark):
    mit, cc, rights = (licenses.TEMPLATES[n] for n in ("mit", "cc-by-nc-4.0", "all-rights-reserved"))
    out = scan(spark, [f"{mit}\n{cc}\n{mit} {rights}", FILLER * 50, "released under water", " ".join([mit] * 1500)])
    assert [r.license for r in out if r.doc_id == 0] == ["mit", "cc-by-nc-4.0", "mit", "all-rights-reserved"]
    assert {r.doc_id for r in out} == {0, 3}
    assert [r.first_word for r in out if r.doc_id == 3] == [5 * i for i in range(1500)]


def test_messy_rows(spark):
    extra = [(8, licenses.TEMPLATES["mit"]), (8, licenses.TEMPLATES["mit"]), (None, licenses.TEMPLATES["mit"])]
    out = licenses.scan_documents(messy(spark, extra)).collect()
    assert sorted(str(r.doc_id) for r in out) == ["8", "8", "None"]
    assert licenses.scan_documents(empty(spark)).collect() == []


def test_words_that_only_look_like_a_template(spark):
    """Parts of words make the block between two notices smaller by a template that shares no word with it."""
    mit = licenses.TEMPLATES["mit"]
    out = scan(spark, [f"{mit} licensing permissions noninfringements {mit}", f"{mit} attributions licensees sharealikes {mit}"])
    assert [(r.doc_id, r.first_word, r.license, r.exact) for r in out] == [(i, at, "mit", True) for i in (0, 1) for at in (0, 8)]
