"""Main text of pages: the model against brute force and gradients, and what it extracts."""

import itertools
import re

import numpy as np
import pytest

from signalweave.llm import html_tree as ht


@pytest.fixture(scope="module")
def model():
    return ht.default_model()


def test_marginals_equal_sums_over_all_states():
    rng = np.random.default_rng(4)
    f = ht.forest(["<div><p>a<p>b</div><ul><li>c</ul>", "<p>x", ""])
    model = ht.Model(rng.normal(size=len(ht.FEATURES)), rng.normal(size=(4, 2, 2)))
    own = np.bincount(f.node, model.weights[f.feature], len(f.parent))
    got, joint = ht.marginals(f, model)
    for a, b in zip(f.start, f.start[1:]):
        total, sums, pairs = 0.0, np.zeros(b - a), np.zeros((b - a, 2, 2))
        for y in itertools.product((0, 1), repeat=int(b - a)):
            score = sum(own[a + i] for i in range(b - a) if y[i]) + sum(model.edges[f.kind[a + i], y[f.parent[a + i] - a], y[i]] for i in range(1, b - a))
            w = np.exp(score)
            total += w
            sums += w * np.array(y)
            for i in range(1, b - a):
                pairs[i, y[f.parent[a + i] - a], y[i]] += w
        assert np.allclose(got[a:b], sums / total) and np.allclose(joint[a:b], pairs / total)


def test_training_raises_the_likelihood_of_the_labels():
    pages = ht.labelled_pages(40, seed=3)
    f = ht.forest(pages)
    y = ht.labels_of(f)

    def fit(m):
        p, _ = ht.marginals(f, m)
        return np.log(np.where(y == 1, p, 1 - p) + 1e-12).mean()

    scores = [fit(ht.train(pages, steps=s)) for s in (1, 20, 80)]
    assert scores[0] < scores[1] < scores[2]


def test_held_out_layouts_and_the_pages_table(model):
    held = ht.labelled_pages(120, seed=77)
    f = ht.forest(held)
    y, (p, _) = ht.labels_of(f), ht.marginals(f, model)
    leaf = np.array([t is not None for page in f.pages for t in page.text])
    assert ((p >= 0.5) == y)[leaf].mean() > 0.97


LINE = "Words of the story go on here, and they end."


@pytest.mark.parametrize(
    "html",
    [
        "<body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header><main><article>{a}</article></main><aside><h3>More</h3><ul><li><a href=1>x y</a></ul></aside><footer>&copy; 2020 me</footer>",
        "<div id=top class=masthead><a href=/>Site</a></div><div class=cookie-notice><p>We use cookies. Go on?</p><button>OK</button></div><div class='post-content'>{a}</div><div id=comments><div class=comment><p>{l}</p></div><form><label>Say</label><textarea>no</textarea></form></div>",
        "<nav><ul><li><a href=1>one</a><li><a href=2>two</a></ul></nav><div class=ad>{l}</div><article>{a}<div class=ad>Buy this now. It is good.</div></article><section class=comments><article class=comment><p>{l} {l}</p></article></section><footer><p>{l}</p></footer>",
    ],
)
def test_common_layouts(model, html):
    article = f"<h1>The  &amp; title</h1><p>{LINE}<p>{LINE}&nbsp;{LINE}</p><p>One.</p><script>var x = '<p>no</p>';</script><p><b>{LINE}<br>a <i>b</i>c"
    assert ht.main_texts([html.replace("{a}", article).replace("{l}", LINE)], model) == [f"The & title\n{LINE}\n{LINE} {LINE}\nOne.\n{LINE} abc".replace(" abc", " a bc")]


def test_trees_of_broken_pages():
    blocks = lambda s: [t for t in ht.Page(s).text if t]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table><p>d<div>e</p>f") == ["a", "b", "c", "d", "e", "f"]
    assert blocks("1 < 2 & 3 &lt; &#52;<!-- x --><p title='a>b'>q<p title=it's>r</p><p tit") == ["1 < 2 & 3 < 4", "q", "r"]
    assert blocks("<head><title>t</title><link><body>a<svg><p>no</p></svg><select><option>A<option>B</select> b<style>p{}") == ["a b"]
    assert blocks("<head>no end<p>a</div></article>b<!-- open") == ["a", "b"]
    assert len(ht.Page("<div>" * 3000 + "x").parent) == 3002


def test_query_on_odd_pages(spark, tmp_path, model):
    page = f"<article><h1>T</h1><p>{LINE}</p></article>"
    long = "<article>" + f"<p>{LINE} {LINE}</p>" * 9000 + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", page, "x"), (4, "u", page, "x"), (4, "u", page, "x"), (5, "u", long, "x"), (6, "u", "   ", "x"), (7, "u", "<nav><a href=1>a</a></nav>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    df.write.parquet(f"{tmp_path}/pages.parquet")
    out = ht.op12_html_tree(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    by = {r["page_id"]: r["text"] for r in out}
    assert by[1] == by[2] == by[6] == by[7] == "" and by[4] == by[None] == f"T\n{LINE}" and by[5] == "\n".join([f"{LINE} {LINE}"] * 9000)
    assert ht.extract_main_text(df.limit(0)).count() == 0


def test_own_labelled_pages_can_be_given(spark):
    own = [f"<div><b>{i}</b><p data-label=1>{LINE}</p><p data-label=0 class=zz>short</p></div>" for i in range(30)]
    labelled = spark.createDataFrame([(x,) for x in own + [None]], "html string")
    pages = spark.createDataFrame([(1, "u", f"<div><p>{LINE}</p></div>")], "page_id long, url string, html string")
    assert ht.extract_main_text(pages, labelled).first()["text"] == LINE


def test_articles_of_the_pages_table(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    wrong = 0
    for (html,), got in zip(rows, ht.main_texts([r[0] for r in rows], model), strict=True):
        inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        want = [" ".join(ht.entities.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        wrong += "\n".join(w for w in want if w) != got
    assert wrong == 0
