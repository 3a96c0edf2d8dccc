"""Extraction: long labelled pages enter the fit."""

from tidemark.llm import html_text


def page(k, words):
    return f"<html><body><div class=promo>{'buy now ' * 30}</div><article><p>{f'word{k} ' * words}</p></article><div class=promo>{'more here ' * 30}</div></body></html>"


def test_long_labelled_pages_enter_the_fit(spark, monkeypatch):
    long = spark.createDataFrame([(k, "u", page(k, 3000)) for k in range(20)] + [(None, "u", page(7, 3000))] * 2, "page_id long, url string, html string")
    assert html_text.fit(long)
    text = {r.page_id: r.text for r in html_text.extract_pages(long).collect()}
    assert text[3] == " ".join(["word3"] * 3000)
    # One that does not fit is passed over, wherever it stands.
    monkeypatch.setattr(html_text, "FIT_BYTES", 60_000)
    mixed = spark.createDataFrame([(k, "u", page(k, 3000 if k % 2 else 20_000)) for k in range(20)], "page_id long, url string, html string")
    assert html_text.fit(mixed)
