"""The template language: parsing, folding, rendering, and what the sandbox refuses."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm.chat_format import (CONTROL, TEMPLATE, Const, TemplateError, Write, _Statements, compile_template,
                                     escape, fold_body, read_back, unescape)


def render(template, **names):
    return compile_template(template)(names)[0]


@pytest.mark.parametrize("template, names, want", [
    ("a{{ 'b' ~ 1 ~ none }}c", {}, "ab1c"),
    ("{{ x.y[0] | upper }}", {"x": {"y": ["q"]}}, "Q"),
    ("{{ missing | default('-') }}", {}, "-"),
    ("{% if a > 1 and not b %}yes{% elif b %}b{% else %}no{% endif %}", {"a": 2, "b": False}, "yes"),
    ("{% for i in l %}{{ loop.index }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", {"l": ["x", "y"]}, "1x,2y"),
    ("{% set n = 2 * (3 + 1) - 1 %}{{ n % 4 }}", {}, "3"),
    ("a  {%- if true -%}  b  {%- endif -%}  c", {}, "abc"),
    ("{# gone #}{{ 'in' if 'a' in l else 'out' }}{{ 'b' not in l }}", {"l": ["a"]}, "inTrue"),
    ("{{ -x + 1 }}{{ l | join('/') }}{{ l | length }}", {"x": 2, "l": ["a", "b"]}, "-1a/b2"),
])
def test_rendering(template, names, want):
    assert render(template, **names) == want


@pytest.mark.parametrize("template", [
    "{{ ''.__class__ }}", "{{ x.__class__ }}", "{{ x() }}", "{{ x | open }}", "{% import os %}", "{% if x %}",
    "{{ 'a' * 1000000000 }}", "{% for c in 'abc' %}{{ c }}{% endfor %}", "{{ a b }}", "{% for 1 in x %}{% endfor %}"])
def test_sandbox_and_mistakes(template):
    with pytest.raises((TemplateError, TypeError)):
        render(template, x=3)


def test_constants_are_folded():
    body = fold_body(_Statements("a{% if 1 + 1 == 2 %}b{{ 'c' | upper }}{% else %}{{ x }}{% endif %}d").body()[0])
    assert body == (Write(Const("abCd")),)


def test_generation_spans_are_code_points():
    said, spans = compile_template("é{% generation %}{{ a }}{% endgeneration %}!{% generation %}{% endgeneration %}")({"a": "ño"})
    assert (said, spans) == ("éño!", [(1, 3)])


PIECES = st.lists(st.sampled_from([*CONTROL, "\\", "<", "|", "end", "[", "/", "é", "\n", ">", "s"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_escape_round_trip(text):
    hidden = escape(text)
    assert unescape(hidden) == text and not any(c in hidden for c in CONTROL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), PIECES), PIECES), max_size=5))
def test_conversations_come_back(turns):
    said, spans = compile_template(TEMPLATE)({"messages": [{"role": r, "text": t} for r, t in turns]})
    got, learnt = read_back(said, [{"first": a, "past": b} for a, b in spans])
    assert got == turns and learnt == "".join(t for r, t in turns if r == "assistant")
