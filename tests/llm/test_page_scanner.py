"""Markup that is left open, quoted or nested, and pages of any length."""

from __future__ import annotations

import time

import pytest

from fleetgauge.llm import html_main_text


def runs(page: str) -> list[str]:
    found = [run for node in html_main_text.parse(page) for run in node.runs]
    return [text for _, text in sorted(found)]


@pytest.mark.parametrize(
    "page,texts",
    [
        ("<button>x<article><p>Hello world</p></article>", ["x", "Hello world"]),
        ("<select><option>a</select><p>b", ["b"]),
        ("<select><option>a<p>b", ["a", "b"]),
        ("<svg><svg>a</svg>b</svg>c", ["c"]),
        ("<p>a <math><mi>x</mi>+1</math> b</p>", ["a x+1 b"]),
        ("<xmp>kept</xmp>", ["kept"]),
        ("<div title='a>b' class=\"x'y\">t</div>", ["t"]),
        ("a < b <c", ["a < b <c"]),
        ("<p>a<!-- open <p>b", ["a"]),
        ("<![CDATA[x]]>y<?php z ?>", ["y"]),
        ("a<script>if (a<b) '</p>'</script>b<style>open", ["ab"]),
        ('<p class="open>x</p><p>y</p>', ['<p class="open>x', "y"]),
    ],
)
def test_markup(page, texts):
    assert runs(page) == texts


@pytest.mark.parametrize(
    "piece", ['<p class="x ', "<a ", "<button>", "<!x ", "<p class='x \" ", "<![CDATA[ ", "<script>", "</1", "<b \"'", "<p>", "<div><span>", "<select><option>", "&amp"]
)
def test_a_megabyte_takes_seconds(piece):
    began = time.time()
    html_main_text.parse(piece * (1_000_000 // len(piece)))
    assert time.time() - began < 12
