"""Pages with elements that browsers show, captions and cells over several rows."""

import pytest

from strata.llm.html_text import page_text


@pytest.mark.parametrize("html, text", [
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> holds", "so x=2 holds"),
    ("<p>see<svg><title>t</title><desc>d</desc><text>One</text><text>Two</text></svg>", "see\nOne\nTwo"),
    ("a<textarea>first\n  second</textarea>b", "a\nfirst\n  second\nb"),
    ("<select><option>red<option hidden>no<option>blue</select>", "red\nblue"),
    ("<object data=x><p>instead</p></object>", "instead"),
    ("<video>no</video><canvas>no</canvas><datalist><option>no</datalist>yes", "yes"),
    ("<table><caption>Title</caption><tr><td>A<td>B</table>", "Title\nA | B"),
    ("<table><caption>Title</caption> <tr><td>A<td>B</table>", "Title\nA | B"),
    ("<table><tr><td rowspan=2>A<td>B<td>C<tr><td>D<td>E<tr><td>F</table>", "A | B | C\n  | D | E\nF"),
    ("<table><tr><td>A<td rowspan=2 colspan=2>B<td>C<tr><td>D<td>E</table>", "A | B |  | C\nD |   |  | E"),
    ("<table><tbody><tr><td rowspan=0>A<td>B<tr><td>C</tbody><tbody><tr><td>D<td>E</table>", "A | B\n  | C\nD | E"),
])
def test_visible_text(html, text):
    assert page_text(html) == text


@pytest.mark.parametrize("html, text", [
    ("a<![foo bar]>b", "ab"),
    ("a<![ if y ]>b", "ab"),
    ("<ol start=1999><li>x<li value=2005>y<li>z</ol>", "1999. x\n2005. y\n2006. z"),
    ("<ol start=-1><li>x<li>y</ol>", "-1. x\n0. y"),
    ("<p style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</p>", "yes"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<details>no<summary>Sum</summary>no</details><details open><summary>S</summary>body</details>", "Sum\nS\nbody"),
    ("<input value=V><input type=hidden value=no><input type=submit value=Go><button>Press</button>", "VGoPress"),
])
def test_rules_of_visibility(html, text):
    assert page_text(html) == text


def test_a_wide_cell_does_not_pad_its_column():
    page = "<table>" + "<tr><td>" + "w" * 50_000 + "<td>x" + "<tr><td>a<td>b" * 2_000 + "</table>"
    text = page_text(page)
    assert len(text) < 4 * len(page) and "w" * 50_000 in text and text.count("a | b") == 2_000


def test_no_page_ends_the_job():
    import random

    draw = random.Random(1)
    bits = ["<", ">", "<!", "<![", "]]>", "<!--", "-->", "&", "&#", "&#x110000;", "&lt", "</", "/>", "'", '"', "=", " ", "\x00", "é", "<?", "<!doctype", "[", "]", "x", "%", "--",
            "table", "tr", "td rowspan=0", "td colspan=-3", "li", "ol start=9", "p", "script", "style", "textarea", "plaintext", "svg", "math", "select", "details", "input value=1", "br", "template"]
    for _ in range(10_000):
        page = "".join(draw.choice(bits) if draw.random() < 0.6 else f"<{draw.choice(bits[26:])}>" for _ in range(draw.randrange(1, 25)))
        assert isinstance(page_text(page), str), page
