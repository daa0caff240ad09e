"""Page parsing: forms around a page, deep nesting, stray tags."""

import time

from registrar.llm import html

TEXT = "A sentence of the article that goes on for a while, as sentences do. " * 8


def test_form_around_the_page_keeps_the_article():
    page = (f"<html><body><form action='/x'><div><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p></div>"
            "<input value='q'><select><option>one</option></select><button>Send</button></form></body></html>")
    text = html.extract_text(page)
    assert text.count("A sentence") == 16 and "Send" not in text and "one" not in text.split()


def test_small_forms_still_go():
    page = (f"<body><form><label>Name</label> write us a line <textarea>x</textarea></form><div><p>{TEXT}</p><p>{TEXT}</p>"
            "<form>Sign up for letters</form></div></body>")
    text = html.extract_text(page)
    assert "write us" not in text and "Sign up" not in text and text.count("A sentence") == 16


def test_nesting_and_stray_tags_take_linear_time():
    began = time.time()
    assert html.extract_text("<div>" * 60_000 + TEXT + "</div>" * 60_000).startswith("A sentence")
    assert html.extract_text(f"<p>{TEXT}" + "</b></i></div>" * 40_000).startswith("A sentence")
    html.extract_text("<p><button>" + "<div>" * 40_000 + "x")
    html.extract_text("<table><tr><td>" + "<p>" * 40_000 + TEXT)
    assert time.time() - began < 40


def test_implied_ends_are_bounded():
    tree = html.parse("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><p>e<div>f</div></p>g<table><tr><td>h<td>i<tr><td>j</table>")
    def shape(x):
        return [p if isinstance(p, str) else (p.tag, shape(p)) for p in x.parts]
    assert shape(tree) == [
        ("ul", [("li", ["a", ("ul", [("li", ["b"]), ("li", ["c"])])]), ("li", ["d"])]), ("p", ["e"]), ("div", ["f"]), "g",
        ("table", [("tr", [("td", ["h"]), ("td", ["i"])]), ("tr", [("td", ["j"])])])]
