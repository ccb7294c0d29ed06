"""Main text against the pages' own article, trees against their rules; the
pipeline stage by stage."""

from __future__ import annotations

import html
import re

import numpy as np

import corpus_pipeline
from pairflow.llm import decontaminate, extract, minhash
from pairflow.llm.common import table

from . import helpers as h

SF = "/root/testdata/sf0.01"


def article(page: str) -> str:
    """The article's blocks by the rules of the given pages."""
    m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", m.group(1)) if m else []
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_driver_pages(spark):
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r for r in extract.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    wrong = [r["page_id"] for r in rows if got[r["page_id"]]["text"] != article(r["html"])]
    assert len(wrong) <= 0.02 * len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


PAGE = """<!doctype html><html><head><title>T</title><style>p{x}</style></head><body>
<header class="site-header"><a href=/>Home</a> <a href=/b>Blog</a></header>
<div id="main-menu"><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul></div>
<article><h1>A &amp; B</h1><p>First   long paragraph of the article,
with many plain words in it, and a <a href=x>link</a> too.<p>Second paragraph has more to say, and
says it at some length, as articles do.</p><script>var t="</p><p>no";</script>
<div class="cookie-notice"><p>We use cookies, please accept them.</p></div>
<blockquote>A quoted line that belongs here, with words.</blockquote>
<form><label>Mail</label><input name=m><button>Send</button></form></article>
<section class="comments"><p>I liked the article a lot, said a reader.</p></section>
<aside><p>Related: other things</p></aside><footer>&copy; 2024 Site</footer></body>"""


def test_boilerplate_of_all_kinds(spark):
    model = extract.fit(table(spark, SF, "pages"))
    text = extract.main_texts([PAGE], model)[0]
    assert text == (
        "A & B\nFirst long paragraph of the article, with many plain words in it, and a link too.\n"
        "Second paragraph has more to say, and says it at some length, as articles do.\n"
        "A quoted line that belongs here, with words.")


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, text string, keep string"
    odd = [None, "", "no markup at all", "<p", "<<<>>>", "<!-- open", "<div>" * 3000 + "deep",
           "</p></div>stray", "<table><tr><td>a<td>b</table>", "<p>&#0;&nope;&lt;b&gt;", PAGE, PAGE,
           "<p>" + "word " * 200_000]
    rows = [(i, None if i % 2 else "u", p, "own", "own") for i, p in enumerate(odd)]
    rows += [(None, None, PAGE, "own", "own"), (h.BIG, "u", PAGE, "own", "own")]
    model = extract.fit(table(spark, SF, "pages"))
    out = extract.extract(spark.createDataFrame(rows, schema), model)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows)
    assert {r["page_id"] for r in got} >= {None, h.BIG}
    same = {r["text"] for r in got if r["page_id"] in (10, 11, None, h.BIG)}
    assert len(same) == 1
    assert {r["text"] for r in got if r["page_id"] in (0, 1)} == {""}
    assert extract.extract(spark.createDataFrame([], schema)).count() == 0


def test_decoder_is_consistent_and_best():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(2, 10))
        parent = np.array([-1] + [int(rng.integers(0, i)) for i in range(1, n)])
        log_odds, own = rng.normal(size=n), rng.integers(0, 50, n).astype(float)
        keep = extract.decode(parent, log_odds, own)
        assert all(keep[parent[i]] for i in range(1, n) if keep[i])
        worth = log_odds * (0.05 + np.sqrt(own))
        best = max(sum(worth[i] for i in range(1, n) if s >> i & 1) for s in range(1, 1 << n, 2)
                   if all(s >> parent[i] & 1 for i in range(1, n) if s >> i & 1))
        assert np.isclose(worth[1:][keep[1:]].sum(), best)


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = extract.boost(x, y)
    assert ((model.log_odds(x) > 0) == (y > 0.5)).mean() > 0.97


def test_pipeline_stages(spark):
    """Each stage against brute force on what its predecessor kept."""
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        from pairflow.llm.common import staged
        frames.append(staged(stage(spark, frames[-1], SF), "test-stage"))
    for f in frames[1:5]:
        assert f.columns == docs.columns
    ids = [[r["doc_id"] for r in f.select("doc_id").collect()] for f in frames[:5]]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    good = [i for i in ids[0] if labels.get(i) == 1]
    assert len(set(good) - set(ids[1])) <= 0.03 * len(good)
    assert sum(labels.get(i) == 0 for i in ids[1]) <= 0.2 * sum(v == 0 for v in labels.values())
    classes = minhash.classes(frames[1]).collect()
    assert sorted(ids[2]) == sorted({r["class_id"] for r in classes})
    items = [" " + " ".join(decontaminate.words_of(r["text"])) + " "
             for r in table(spark, SF, "benchmark").collect()]
    texts = {r["doc_id"]: r["text"] for r in frames[2].collect()}
    leaked = {i for i, t in texts.items()
              if any(x in " " + " ".join(decontaminate.words_of(t)) + " " for x in items)}
    assert set(ids[3]) == set(texts) - leaked
    after = {r["doc_id"]: r["text"] for r in frames[4].collect()}
    assert after.keys() == set(ids[3])
    assert not any(re.search(r'(token|password)\s*=\s*"?[0-9a-f]{16}', t) for t in after.values())
    assert all(after[i] == texts[i] for i in after if "token = " not in texts[i]
               and "password=" not in texts[i] and "AKIA" not in texts[i])
    pieces = frames[5].toPandas()
    assert set(pieces["doc_id"]) == after.keys()
    assert (pieces.groupby("doc_id")["length"].sum()
            == pieces.groupby("doc_id")["doc_tokens"].first()).all()


PLAIN = ("<html><body><nav><a href=/>Home</a></nav><div><p>Plain text number {} with some words."
         "</p></div><footer>Foot</footer></body></html>")


def test_rare_marked_pages_train(spark):
    """The bound counts marked pages, and a false look draws more."""
    rows = [(i, "u", PLAIN.format(i)) for i in range(1500)]
    rows += [(5000 + i, "u", "<!-- <article > -->" + PLAIN.format(i)) for i in range(500)]
    rows += [(9000 + i, "u", PAGE) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = extract.fit(pages, max_pages=20)
    assert isinstance(model, extract.Boosted)
    assert "Second paragraph has more to say" in extract.main_texts([PAGE], model)[0]


def test_pages_without_marks_keep_their_text(spark):
    pages = spark.createDataFrame([(i, "u", PLAIN.format(i)) for i in range(30)],
                                  "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract.extract(pages).collect()}
    assert got == {i: f"Plain text number {i} with some words." for i in range(30)}


def all_text(page):
    nodes, *_, texts = extract.describe(extract.parse(page))
    return [x for t in texts for x in t]


def test_unclosed_elements_end_before_the_next_block():
    for tag in extract.DROPPED:
        lost = f"<div><{tag}>Menu <b>x</b><article><p>First.</p><p>Second.</p></article></div>"
        assert all_text(lost) == ["First.", "Second."], tag
        again = lost + f"<footer><{tag}>Top</{tag}> End</footer>"
        assert all_text(again) == ["First.", "Second.", "End"], tag
        stray = lost + f"<footer>End</{tag}></footer>"
        assert all_text(stray) == ["First.", "Second.", "End"], tag
        parent = f"<div><p>One <{tag}>no</p>loose</div><p>Two</p>"
        assert all_text(parent) == ["loose", "One", "Two"], tag
        closed = f"<p>One</p><{tag}><div>no <p>not</div></{tag}><p>Two <{tag}>no</{tag}>end</p>"
        assert all_text(closed) == ["One", "Two end"], tag
    assert all_text("<p>One</p><script>var a <p>Two</p>") == ["One"]
