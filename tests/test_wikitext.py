"""Golden cases of the text kernel, worked out by hand, and properties that hold for any text."""

from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomtext.options import Options, file_size
from loomtext.wikitext import clean, spans
from loomtext.wikitext.templates import Expander, Site, switch

OPTIONS = Options(as_of=datetime(2024, 1, 2, tzinfo=timezone.utc))


def text_of(raw, options=OPTIONS, **templates):
    return clean.plain_text(raw, options, Expander(Site({f"Template:{k}": v for k, v in templates.items()}), "P", options.as_of))


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("'''Foo''' is a [[New York|big city]]s.", "Foo is a big_citys.\n"),
        ("See [[File:x.png|thumb|cap]] here", "See here\n"),
        ("A &lt;ref&gt;note&lt;/ref&gt; B", "A B\n"),
        ("A &lt;ref name=&quot;a/b&quot;&gt;note&lt;/ref&gt; B", "A note B\n"),
        ("Pop 1,234,567 and 12,345.", "Pop 1234567 and 12345.\n"),
        ("Pair 1,234 12,345 end", "Pair 1234 12,345 end\n"),
        ("x {{lc:ABC}} {{#if: x | yes | no}} {{PAGENAME}}", "x abc yes P\n"),
        ("x {{#switch: a | b = 1 | 2}} y", "x y\n"),
        ("x {{#expr: 1 + 2}} y", "x 3 y\n"),
        ("x {{Unknown|z}} y", "x y\n"),
        ("== H ==\n=== E ===\n* item\npara", "para\n"),
        ("&lt;math&gt;x&lt;/math&gt; or &lt;math&gt;y&lt;/math&gt;", "formula_1 or formula_2\n"),
        ("the ''Title'' here", 'the "Title" here\n'),
        ("a [http://a.b/c the label] b", "a the label b\n"),
        ("{| x\n| a\n|}\nafter", "after\n"),
        ("", ""),
    ],
)
def test_golden(raw, expected):
    assert text_of(raw) == expected


def test_template_parameters():
    assert text_of("x {{T}} / {{T|Bob}}", T="Hi {{{1|you}}}") == "x Hi you / Hi Bob\n"
    assert text_of("{{T|a=b=c| d }}", T="{{{a}}}{{{1}}}.") == "b=cd.\n"
    assert text_of("{{T|p=q|q=r}}x", T="{{{{{{p}}}}}}") == "rx\n"
    assert text_of("{{L}}end", L="{{L}}") == "end\n"
    assert text_of("{{Template:T}}x", T="no") == "x\n"


def test_counts_of_what_was_given_up():
    e = Expander(Site({"Template:L": "{{L}}"}), "P", OPTIONS.as_of)
    e.expand("{{L}}")
    assert e.depth_errors + e.call_errors > 0
    e.expand("{{ }}")
    assert e.title_errors == 1


def test_functions():
    assert text_of("{{#switch: b | a | b = ab | #default = d}}|{{#switch: z | a = 1 | #default = d}}.") == "ab|d.\n"
    assert switch(False)("z", "a = 1", "last") == "last"
    assert text_of("{{#ifeq: a | a | same | other }}{{#iferror: {{#expr: 1 + }} | bad | good }}{{int: x}}.") == "same bad .\n"
    assert text_of("x{{#expr: __import__('os') }}.") == "x.\n"
    assert text_of("{{urlencode: a b/ü}}.") == "a%20b/%C3%BC.\n"
    assert text_of("{{convert|5|km}}.", Convert="{{#invoke:convert|convert}}") == "5 km.\n"


def test_options():
    sections = Options(sections=True, as_of=OPTIONS.as_of)
    assert text_of("== H ==\npara", sections) == "H.\npara\n"
    lists = Options(lists=True, as_of=OPTIONS.as_of)
    assert text_of("== H ==\n* a\n** b\n# c", lists) == "H.\n- a\n- b\n1. c\n"
    assert text_of("a {{b}} c", Options(expand_templates=False, as_of=OPTIONS.as_of)) == "a c\n"
    assert text_of("a [[b|c d]] [http://x.y z]", Options(links=True, as_of=OPTIONS.as_of)) == "a c_d z\n"
    assert file_size("1M") == 1 << 20
    with pytest.raises(ValueError):
        file_size("1K")


def test_left_templates():
    assert clean.left_templates("a {{lang|fr|mot}} b\n{{lang|fr|mot}} b\n{{IPA|x}}\nd {{zz}} e\nf") == "\nmot b\nx\n\nf"
    with pytest.raises(IndexError):
        clean.left_templates("{{IPA}}")


def test_braces():
    assert list(spans.brace_spans("{{{{{x}}} }}", 3)) == [(2, 9)]
    assert list(spans.brace_spans("a {{b|{{c}}}} d {{e", 2)) == [(2, 13)]
    assert spans.split_parts("a|[[b|c]]|{{d|e}}|f") == ["a", "[[b|c]]", "{{d|e}}", "f"]
    assert spans.drop_nested("a{|b{|c|}d|}e", r"\{\|", r"\|\}") == "ae"
    assert spans.drop_nested("a{|b", r"\{\|", r"\|\}") == "a{|b"
    assert list(spans.link_spans("]] [[a [[b]] c]] [[d")) == [(3, 16)]


markup = st.text(alphabet="ab |=:*#;{}[]<>/'\"&\n", max_size=120)


@settings(max_examples=150, deadline=None)
@given(markup)
def test_any_text_ends(raw):
    out = clean.clean(raw, OPTIONS, Expander(Site(), "P", OPTIONS.as_of))
    assert not clean.re.search(r"<[^>]*>", clean.re.sub(r"<[^>]*>", "", out)) or "<" in out
    assert len(spans.drop_nested(raw, r"\{\|", r"\|\}")) <= len(raw)
    assert "|".join(spans.split_parts(raw)) == raw


def test_passes_without_anything_to_do_are_left_out(monkeypatch):
    """most of a short page's time was in patterns that can't match."""
    from loomtext.options import Options
    from loomtext.wikitext import clean

    ran, drop = [], clean.drop_nested
    monkeypatch.setattr(clean, "drop_nested", lambda text, *p: ran.append(p) or drop(text, *p))
    assert clean.plain_text("a short page, '''bold'''.", Options(expand_templates=False), None) == "a short page, bold.\n"
    assert len(ran) <= 1
    # a region that goes may leave a tag behind, and letters of other alphabets count where case doesn't
    assert clean.plain_text("a <r<table>x</table>ef>y</ref>b", Options(expand_templates=False), None) == "a b\n"
    assert clean.plain_text("a <ſmall>y</small>b", Options(expand_templates=False), None) == "a b\n"
