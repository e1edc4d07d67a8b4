"""Whole queries against plain versions of them: quality and main text."""

import math
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import htmltext, quality

PATH = "/root/testdata/sf0.001"


class Article(HTMLParser):
    """Blocks inside article elements, outside menus, adverts and scripts."""

    BREAKS = {"p", "h1", "h2", "h3", "div", "ul", "ol", "li", "table", "tr", "article", "section", "blockquote", "nav", "footer", "header", "aside", "form"}
    DROPS = {"nav", "footer", "aside", "form", "script", "style"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.dropped, self.parts, self.blocks = 0, 0, [], []

    def flush(self):
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in self.BREAKS:
            self.flush()
        if tag in ("br", "td", "th"):
            self.handle_data(" ")
        self.inside += tag == "article"
        self.dropped += tag in self.DROPS

    def handle_endtag(self, tag):
        if tag in self.BREAKS:
            self.flush()
        self.inside -= tag == "article"
        self.dropped -= tag in self.DROPS

    def handle_data(self, data):
        if self.inside and not self.dropped:
            self.parts.append(data)


def test_main_text_of_all_pages(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in htmltext.query(spark, PATH).collect()}
    pages = spark.read.parquet(f"{PATH}/pages.parquet").collect()
    assert len(got) == len(pages) > 0
    for page in pages:
        x = Article()
        x.feed(page.html or "")
        x.close()
        x.flush()
        want = "\n".join(x.blocks)
        assert got[page.page_id] == (want, len(want)), page.page_id


def plain_features(text):
    """Gram bins and shares of a text, byte by byte."""
    kinds = [97 if 97 <= c < 123 or c > 127 else 65 if 65 <= c < 91 else 48 if 48 <= c < 58 else 32 if c in (9, 11, 12, 32) else 10 if c in (10, 13) else c for c in text]
    bins = [0] * quality.GRAMS
    for a, b, c, d in zip(kinds, kinds[1:], kinds[2:], kinds[3:]):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D ^ d * 0x27D4EB2F) * 0x165667B1 & 0xFFFFFFFF
        bins[h >> 22] += 1
    words = text.split()
    n, size = len(words), len(text)
    triples = list(zip(words, words[1:], words[2:]))
    count = lambda keep: sum(map(keep, text))
    marks = count(lambda c: 33 <= c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 127)
    shares = [
        sum(a == b for a, b in zip(words, words[1:])) / (n - 1) if n > 1 else 0.0,
        1 - len(set(triples)) / len(triples) if triples else 0.0,
        len(set(words)) / n,
        count(lambda c: 65 <= c < 91) / size,
        marks / size,
        count(lambda c: 48 <= c < 58) / size,
        text.count(b"|") / n,
        text.count(b"!") / n,
        min(1.0, (size - n) / n / 16),
        min(1.0, text.count(b"\n") / n * 8),
    ]
    return np.array(bins + shares, np.float32)


def plain_score(model, text):
    """The vote of the nearest labelled vectors, one cosine after another."""
    if not text.strip():
        return 0.0
    x = plain_features(text)
    grams = [math.log1p(v) * w for v, w in zip(x[: quality.GRAMS].tolist(), model.idf.tolist())]
    length = math.sqrt(sum(v * v for v in grams)) or 1.0
    weighted = np.array([v / length for v in grams] + [quality.SHARE_WEIGHT * math.sqrt(max(v, 0.0)) for v in x[quality.GRAMS :].tolist()])
    own = weighted @ model.basis.astype(np.float64)
    own /= math.sqrt((own * own).sum()) or 1.0
    near = sorted(((float(own @ v.astype(np.float64)), i) for i, v in enumerate(model.vectors)), key=lambda p: (-p[0], p[1]))[: quality.NEIGHBOURS]
    votes = [(max(c, 0.0) ** quality.SHARPNESS * float(model.weight[i]), float(model.labels[i])) for c, i in near]
    total = sum(v for v, _ in votes)
    return sum(v * y for v, y in votes) / total if total else 0.0


def test_quality_of_all_documents(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{PATH}/labels.parquet"))
    assert len(model.vectors) > 20
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    got = quality.query(spark, PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.score == pytest.approx(plain_score(model, texts[r.doc_id]), abs=2e-3), r.doc_id
        assert r.predicted == (r.score >= 0.3)
    assert got and docs.filter(F.col("doc_id").isNull()).count() == 0
