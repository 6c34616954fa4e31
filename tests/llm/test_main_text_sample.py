"""What main text is learned from."""

from __future__ import annotations

from spanpack.llm import html_main
from spanpack.llm.dom import parse


def marked(i: int, more: str = "") -> str:
    text = "".join(f"<p{more}>Sentence number {j} of story {i} tells something, at some length.</p>" for j in range(8))
    return f"<html><body><nav><a href='/'>Home</a><a href='/b'>Other pages</a></nav><article>{text}</article><footer>All rights reserved {i}.</footer></body></html>"


def pages(spark, htmls: list[str]):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")


def test_few_marked_pages_are_all_sampled(spark):
    plain = [f"<div><p>plain page {i}</p><article></article></div>" for i in range(600)]
    some = [marked(i) for i in range(12)]
    both = html_main.learn(pages(spark, plain + some), sample=12)
    alone = html_main.learn(pages(spark, some), sample=12)
    assert both is not None and alone is not None
    assert html_main.extract_texts([marked(99)], both) == ["\n".join(f"Sentence number {j} of story 99 tells something, at some length." for j in range(8))]


def test_no_marked_page_gives_the_rule(spark):
    assert html_main.learn(pages(spark, ["<article></article><div><p>x</p></div>", "<p>y</p>"])) is None


def test_labels_of_given_pages_are_not_read(spark):
    for more in (' data-y="12.5"', ' data-y="slow"', " DATA-Y=0", ""):
        htmls = [marked(i, more) for i in range(20)]
        model = html_main.learn(pages(spark, htmls))
        assert html_main.extract_texts([marked(7)], model)[0].count("story 7") == 8
    assert set(parse(marked(1, ' data-y="1"'), labelled=False).label) == {None}
