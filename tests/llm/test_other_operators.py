"""The other operators against brute force on small documents."""

import math
import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.llm import graphs, html, jaccard, mixing, quality, search, toxicity
from tests.llm import docs as D

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- mixing


def water_level(sizes: list[int], weights: list[float], cap: float) -> list[float]:
    target, total, capped = [0.0] * len(sizes), float(sum(sizes)), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(target[i] for i in capped)
        for i in free:
            target[i] = left * weights[i] / sum(weights[j] for j in free)
        over = [i for i in free if target[i] > cap * sizes[i] + 1e-9]
        if not over:
            return target
        for i in over:
            target[i] = cap * sizes[i]
        capped |= set(over)


def test_mix_meets_its_targets(spark):
    rng = random.Random(1)
    share = {"a": 400, "b": 60, "c": 20, None: 3, "d": 1}
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.choice([5, 8, 13, 40, 90]))), s) for i, s in enumerate([s for s, n in share.items() for _ in range(n)])]
    rows += [(1000 + i, "same words here", "a") for i in range(300)] + [(2000, None, "a"), (2001, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORDS.findall(t or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = dict(zip(order, water_level([sizes[s] for s in order], [1.0 + i % 3 for i in range(len(order))], 3.0), strict=True))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    for s in order:
        assert 0 <= want[s] - taken[s] <= max(largest[s], 1)
    assert abs(want["a"] - taken["a"]) < 10
    again = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    assert mixing.repeat_copies(mixing.mix(docs)).count() == sum(r.copies for r in got)


def test_mix_odd_rows(spark):
    assert mixing.mix(D.empty(spark)).count() == 0
    assert mixing.mix(D.make(spark)).count() == len(D.ROWS)


# --- html


def test_main_text_of_pages():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><nav><a href=x>Menu</a></nav><header><h1>Site</h1></header>
    <div id="main"><h2>Head&shy;line &amp; more</h2><p>A first paragraph with enough words to be taken for the text of an article.</p>
    <p>Short.</p><div class="ad-box">Buy this now, it is cheap and good, buy this now, it is cheap.</div>
    <p>A second one,  with
    white space &lt;kept&gt; as one, and a <a href=y>link</a> in it, too.</p><script>var x = "</p>";</script></div>
    <section class="comments"><p>I like this text very much, and so do all of my friends, I think.</p></section>
    <aside>Other things</aside><form>Name <input></form><footer>&copy; Site</footer></body>"""
    assert html.main_text(page) == "Head\xadline & more\nA first paragraph with enough words to be taken for the text of an article.\nShort.\nA second one, with white space <kept> as one, and a link in it, too."
    assert [html.main_text(x) for x in (None, "", "<", "<nav>x</nav>", "<!-- a", "<script>x")] == [""] * 6


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -1.0, -0.25, 0.0, 0.5, 1.0, 2.5]), min_size=1, max_size=10), st.randoms(use_true_random=False))
def test_the_cut_is_minimal_and_the_flow_maximal(scores, rng):
    groups, path = [], [0]  # elements open and close as in a page
    for i in range(len(scores)):
        if rng.random() < 0.5:
            path.append(i + 1)
        elif len(path) > 1 and rng.random() < 0.5:
            path.pop()
        groups.append(path[-1])
    edges = [(i, j, c * rng.choice([0.25, 1.0, 3.0])) for i, j, c in html.smoothness(scores, groups)]

    def cost(side):
        return sum(max(s, 0) if not side[i] else max(-s, 0) for i, s in enumerate(scores)) + sum(c for i, j, c in edges if side[i] != side[j])

    least = min(cost([bool(m >> i & 1) for i in range(len(scores))]) for m in range(1 << len(scores)))
    flow, side = html.maximum_flow(scores, edges)
    assert cost(side) == pytest.approx(least) and flow == pytest.approx(least)


def test_pages_of_many_blocks_take_time_in_proportion():
    import time

    rng = random.Random(2)
    took = []
    for n in (20_000, 100_000):
        scores = [rng.choice([-0.02, -0.01, 0.0, 0.01, 0.02]) for _ in range(n)]
        begin = time.process_time()
        html.maximum_flow(scores, html.smoothness(scores, [0] * n))
        page = "<ul>" + "<li>five words of some kind</li><li><a href=x>link</a></li>" * (n // 2) + "</ul>"
        html.main_text(page)
        took.append(time.process_time() - begin)
    assert took[1] < 10


def test_weights_are_fitted_on_marked_pages_and_are_the_prior_without_any():
    assert html.fit([]) == html.fit(["<p>No article here.</p>", ""]) == html.PRIOR
    article = "<nav><a href=x>Menu</a></nav><article><h2>A title</h2>" + "<p>" + "plain words of an article, " * 4 + "and an end.</p>" * 3 + "</article><div>Buy now</div>"
    w = html.fit([article] * 20)
    x = np.array([b.features for b in html.blocks_of(article)])
    y = np.array([float(b.article) for b in html.blocks_of(article)])

    def loss(v):
        z = x @ v
        share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * html.FIT_CASES
        return float((share * (np.logaddexp(0, z) - y * z)).sum() + ((v - np.array(html.PRIOR)) ** 2).sum() / 2)

    w = np.array(w)
    for i in range(len(w)):  # no better weights nearby
        for step in (-0.01, 0.01):
            assert loss(w) < loss(w + step * np.eye(len(w))[i])


def prose(rng, n=30):
    return " ".join(rng.choice(["river", "stone", "the", "of", "light", "and", "idea", "was", "seen"]) for _ in range(n)).capitalize() + "."


def invented_page(rng):
    """(page, its main text) in one of several layouts."""
    nav = rng.choice(["<nav><ul><li><a href=/a>News</a><li><a href=/b>Sport</a></ul></nav>", "<div class=menu><a href=/a>News</a> <a href=/b>Sport</a></div>", "<header><a href=/>Home</a><p>The daily site</p></header>"])
    title, body = prose(rng, 6)[:-1], [prose(rng, rng.randint(8, 60)) for _ in range(rng.randint(3, 7))]
    shape = rng.choice(["<p>%s</p>", "<div>%s</div>", "<p>%s"])
    inner = f"<h1>{title}</h1>" + "".join(shape % t for t in body)
    if rng.random() < 0.4:
        inner += "<ul><li>" + prose(rng, 9) + "</li></ul>"
        body = [*body, re.search("<li>(.*)</li>", inner)[1]]
    wrap = rng.choice(["<article>%s</article>", "<main>%s</main>", "<div class='content has-sidebar'>%s</div>", "<div id=post-7>%s</div>", "<div class='page no-sidebar'>%s</div>", "<div class='with-comments'>%s</div>", "<div class='tags-science post'>%s</div>", "<div class='print-area'>%s</div>"])
    extra = rng.choice(["<div class=ad>Buy now and save.</div>", "<aside>Other texts you may like</aside>", "<div class=cookie-notice>We use cookies to make this site better for you.</div>", "<form>Name <input><button>Send</button></form>"])
    comments = rng.choice(["", f"<div class=comments><h3>Comments</h3><p>{prose(rng, 12)}</p><p>{prose(rng, 20)}</p></div>"])
    head = rng.choice(["<head><title>x</title></head>", "<head><title>x</title>", ""])
    return f"<html>{head}<body>{nav}{wrap % inner}{extra}{comments}<footer>&copy; The daily site. All rights reserved.</footer></body></html>", "\n".join([title, *body])


def test_invented_pages_of_several_layouts():
    rng = random.Random(21)
    pages = [invented_page(rng) for _ in range(300)]
    weights = html.fit([p for p, _ in pages[:150]])
    for w in (html.PRIOR, weights):
        common = got = want = 0
        for page, text in pages[150:]:
            a, b = Counter(html.main_text(page, w).split()), Counter(text.split())
            common, got, want = common + (a & b).total(), got + a.total(), want + b.total()
        assert 2 * common / (got + want) > 0.98


def test_articles_under_wrappers_of_any_name_and_with_formulas_are_whole():
    for name in ("has-sidebar", "page no-sidebar", "with-comments", "layout-sidebar-left", "single-post related-off", "print-area", "tags-science post"):
        text = "One article of two hundred characters and some more stands alone on this page, in a wrapper of an odd name that tells nothing of what it holds, and it has to be found whole, to its very last word here."
        assert html.main_text(f"<html><body><div class='{name}'><p>{text}</p></div></body></html>") == text
    formula = "<article><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is what all of this is about, as we will see below.</p></article>"
    assert html.main_text(formula) == "The sum a+b is what all of this is about, as we will see below."


def comment(rng, name):
    tag, cls = rng.choice([("li", "comment"), ("div", "comment-body"), ("article", "comment"), ("div", "")])
    who = f"<b>{rng.choice(['Ann', 'Bo', 'Cy'])}</b> {rng.randint(1, 23)} hours ago"
    return f"<{tag} class='{cls if name else 'c-item'}'><div class=meta>{who}</div><p>{prose(rng, rng.randint(5, 60))}</p></{tag}>" if name else f"<div class='c-item'><div>{who}</div><p>{prose(rng, rng.randint(5, 60))}</p></div>"


@pytest.mark.parametrize("n", [1, 3, 8, 30, 100])
def test_reader_comments_are_left_out(n):
    """However many there are, inside and outside of article and main, by their own names or by their bylines."""
    rng = random.Random(n)
    common = got = want = 0
    for _ in range(20):
        for place in ("beside", "article", "main", "bare"):
            for name in ("<section id='comments'>%s</section>", "<div class='comments'>%s</div>", "<div id='comment-list'>%s</div>", "<ol class='commentlist'>%s</ol>", "<div id=respond>%s</div>", "<div class='post-comments wide'>%s</div>", None):
                if name is None and (n < 3 or place in ("article", "main")):
                    continue
                title, body = prose(rng, 6)[:-1], [prose(rng, rng.randint(20, 60)) for _ in range(3)]
                inner = f"<h1>{title}</h1>" + "".join(f"<p>{t}</p>" for t in body)
                comments = (name or "<div class='feed'>%s</div>") % "".join(comment(rng, name) for _ in range(n))
                page = {"beside": f"<article>{inner}</article>{comments}", "article": f"<article>{inner}{comments}</article>", "main": f"<main>{inner}{comments}</main>", "bare": f"<div>{inner}</div>{comments}"}[place]
                a, b = Counter(html.main_text(f"<html><body>{page}</body></html>").split()), Counter([*title.split(), *" ".join(body).split()])
                common, got, want = common + (a & b).total(), got + a.total(), want + b.total()
    assert 2 * common / (got + want) > 0.97


def test_headers_notices_and_lists():
    body = "".join(f"<p>{prose(random.Random(i), 40)}</p>" for i in range(3))
    text = html.main_text(f"<article>{body}</article>")
    assert text.count("\n") == 2
    for around in (
        "<div class='site-header'>The daily site, every day anew</div>%s", "%s<div class='bottom'>Contact us | Imprint | Terms</div>", "%s<p>Contact us | Imprint | Terms | Jobs</p>",
        "<div id=header><h2>The daily site</h2></div>%s", "%s<div class='cookie-banner'><p>We use cookies to make this better.</p></div>",
    ):
        for wrap in ("<article>%s</article>", "<div>%s</div>"):
            assert html.main_text(f"<html><body>{around % (wrap % body)}</body></html>") == text, (around, wrap)
    for notice in ("Subscribe to our newsletter for more of this.", "Advertisement", "Abonnieren Sie unseren Newsletter!", "Read more: another text of ours", "We use cookies to make this better."):
        assert html.main_text(f"<article>{body}<div>{notice}</div></article>") == text, notice
    listed = f"<div><h1>A title of some words</h1>{body}<ul><li>the first thing of three</li><li>a second one</li><li>the third and last of them</li></ul></div>"
    assert html.main_text(f"<html><body><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>{listed}</body></html>") == f"A title of some words\n{text}\nthe first thing of three\na second one\nthe third and last of them"
    # A scientific article's own discussion, and headings of an article's header, stay.
    assert html.main_text(f"<main><header><h1>Of rivers and of stones</h1></header>{body}<section id='discussion'>{body}</section></main>") == f"Of rivers and of stones\n{text}\n{text}"


@pytest.mark.parametrize("part", ["<b>", "<span>word ", "<svg>", "<button>", "<div></i>", "<p>x", "<li>", "<div class=ad>x", "<div class='comments'>y ", "<table><td>z", "<a href=x>w", "<head>", "<div class=item><p>x</p>"])
def test_open_elements_take_time_in_proportion(part):
    begin = time.process_time()
    html.main_text(part * 100_000)
    assert time.process_time() - begin < 5


def test_extract(spark):
    page = "<article><h1>T</h1><p>" + "word " * 50 + "</p></article><footer>f</footer>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<p>" * 5000 + "x y. " * 40_000)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert [len(r.text.split("\n")) for r in got[:2]] == [2, 2] and got[2].text == got[3].text == "" and len(got[4].text) == 199_999


# --- quality


def brute_counts(text: str | None) -> tuple:
    t = text or ""
    w = WORDS.findall(t)
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])].append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_base_counts_and_ratio(spark):
    rng = random.Random(3)
    odd = [" ".join(rng.choice(["a", "b", "#c", "d|", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    odd += ["x y z q r s t u " * 5, "line\nline\n\n \nother\nline", "é\x0b\x0cß\r\n日本\x1cx", " ", "one two three four five six seven"]
    good = [" ".join(rng.choice(["the", "of", "and", "in", "river", "stone"]) for _ in range(60)) for _ in range(60)]
    bad = [" ".join(rng.choice(["THE!!", "OF!!", "%%%", "|"]) for _ in range(60)) for _ in range(10)]
    texts = [*odd, *good, *bad, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(odd), len(odd) + 40)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(t), repr(t)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    scores = [got[i].quality_score for i in range(len(texts))]
    clean = [i for i in range(len(odd), len(odd) + 60)]
    junk = [i for i in range(len(odd) + 60, len(odd) + 70)]
    assert all(got[i].kept or got[i].base_failed for i in clean) and not any(got[i].kept for i in junk)
    assert min(scores[i] for i in clean) > max(scores[i] for i in junk)


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(None, 1, None), (1, None, 1)], "doc_id long, quality int, toxic int")
    assert quality.judge(D.make(spark), labels).count() == len(D.ROWS)
    assert quality.judge(D.empty(spark), labels.limit(0)).count() == 0


# --- toxicity


def labelled_docs():
    rng = random.Random(5)
    plain = lambda n: [rng.choice(["river", "stone", "light", "idea", "the", "los", "lower"]) for _ in range(n)]
    rows = []
    for i in range(600):
        words, toxic = plain(rng.randint(10, 60)), int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "loser,", "lowlife" + rng.choice("abcdef")]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxic_documents_are_found_and_others_left_alone(spark):
    rows = labelled_docs()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (9000, ""), (9001, "x " * 50_000)], "doc_id long, text string").withColumn("toxicity", F.lit("clash"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (9001, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    wrong = [i for i, _, y in rows if (got[i].toxicity >= 0.5) != bool(y)]
    assert len(wrong) <= 3
    toxic = next(r for r in rows if r[2])
    assert {toxic[1][s.start : s.start + s.length].strip(",")[:5] for s in got[toxic[0]].toxic_spans} <= {"idiot", "loser", "lowli"}
    assert got[None].toxicity == got[9000].toxicity == got[9001].toxicity == 0.0
    assert toxicity.score_toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_fitting_the_chain_takes_a_small_multiple_of_its_sample():
    rng, sample = random.Random(6), []
    for i in range(300):
        words = ["".join(rng.choices("aeioubcdst", k=4)) for _ in range(600)]
        for _ in range(15 * (i % 3 == 0)):
            words[rng.randrange(600)] = "idiot"
        sample.append((" ".join(words), int(i % 3 == 0)))
    tracemalloc.start()
    try:
        chain = toxicity.train(sample)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert chain.weights["=idiot"] > 0
    assert peak < 12 * sum(len(t) for t, _ in sample)


def test_marginals_equal_those_of_all_paths():
    import itertools

    import numpy as np

    chain = toxicity.Chain({"=bad": 3.0, "bad": 1.0}, -2.0, np.array([[0.0, -1.0], [0.5, 0.25]]), -0.5)
    words = ["a", "bad", "b", "c", "bad", "d"]
    scores = [chain.emission(w) for w in words]
    total, hit = 0.0, [0.0] * len(words)
    for path in itertools.product((0, 1), repeat=len(words)):
        z = math.exp(sum((chain.bias + s) * y for s, y in zip(scores, path, strict=True)) + chain.start * path[0]) * math.prod(chain.moves[a, b] for a, b in zip(path, path[1:], strict=False))
        total += z
        for i, y in enumerate(path):
            hit[i] += z * y
    at = [i for i, s in enumerate(scores) if s]
    assert chain.marginals(len(words), at, [scores[i] for i in at]) == pytest.approx([hit[i] / total for i in at])


# --- Jaccard join


def brute_components(rows):
    def grams(t):
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), len({find(i) for i in range(len(rows))})


def near_copies():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for g in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 80]))]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append(" ".join(words))
    rows += [" ".join([rng.choice(vocabulary) for _ in range(rng.randint(1, 20))] + passage) for _ in range(40)]
    rows += ["", None, " \n", "a b", "A  B", "a b c", "x y z q r", "X y z q R"]
    rng.shuffle(rows)
    return [(None if i == 17 else i * 3 + 1, t) for i, t in enumerate(rows)]


def test_components_match_brute_force(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    want, groups = brute_components(rows)
    got = jaccard.link_components(docs.repartition(7))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want
    kept = jaccard.keep_one(docs).collect()
    assert len(kept) == groups


def test_components_odd_rows(spark):
    got = {(r.doc_id, r.component_id) for r in jaccard.link_components(D.make(spark)).collect()}
    assert {(1, 1), (5, 1), (2, 2), (3, 3), (None, None), (6, 6)} <= got
    assert sorted(r.doc_id or 0 for r in jaccard.keep_one(D.make(spark)).collect()) == [0, 1, 2, 3, 4, 6, 7]
    once = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "other words entirely, five or six")]
    assert jaccard.keep_one(spark.createDataFrame(once, "doc_id long, text string")).count() == 2
    assert jaccard.link_components(D.empty(spark)).count() == 0 == jaccard.keep_one(D.empty(spark)).count()


def test_connected_components_of_paths_stars_and_rings(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, i) for i in range(1001, 1050)]
    ring = [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)]
    edges = spark.createDataFrame([*path, *star, *ring, (5000, 5000)], "u long, v long")
    labels = {r.node: r.label for r in graphs.connected_components(edges).collect()}
    assert len({labels[i] for i in range(41)}) == len({labels[i] for i in range(1000, 1050)}) == len({labels[2000 + i] for i in range(30)}) == 1
    assert len(set(labels.values())) == 3


# --- search


def brute_search(rows, queries, k):
    tf = [Counter((t or "").encode().translate(search.TABLE).split()) for _, t in rows]
    length = [sum(c.values()) for c in tf]
    mean, n = sum(length) / len(rows), len(rows)
    df = Counter(w for c in tf for w in c)
    out = []
    for q, t in queries:
        scores = []
        for (d, _), c, size in zip(rows, tf, length, strict=True):
            s = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size / mean)) for w in set((t or "").encode().translate(search.TABLE).split()) if w in c)
            if s > 0:
                scores.append((-round(s, 5), math.inf if d is None else d))
        out += [(q, d, i + 1) for i, (_, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_search_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "COMMON", 5)
    monkeypatch.setattr(search, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(search, "CHUNK_DOCS", 100)
    monkeypatch.setattr(search, "STEP_POSTINGS", 40)
    monkeypatch.setattr(search, "STEP_EXACT", 7)
    rng = random.Random(11)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for i in range(600)]
    rows += [(600 + i, rows[50][1]) for i in range(20)] + [(None, rows[50][1]), (700, ""), (701, None), (750, "ünïcode Wörter, W1!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    queries = [(d, t) for d, t in rows if d is not None and d % 50 == 0]
    got = search.top_k(docs.repartition(3), docs.where(search.every_fiftieth(F.col("doc_id"))), k=10)
    assert sorted((r.query_id, math.inf if r.doc_id is None else r.doc_id, r["rank"]) for r in got.collect()) == brute_search(rows, queries, 10)


def test_blocks_that_cannot_reach_the_kth_score_are_skipped(spark, tmp_path, monkeypatch):
    """Once the best are known, a chunk's blocks without the query's telling words are not scored, and nothing changes."""
    monkeypatch.setattr(search, "COMMON", 2)
    monkeypatch.setattr(search, "BLOCK", 4)
    monkeypatch.setattr(search, "PROBE", 1)  # bound the blocks of every chunk
    rows = [(i, " ".join([f"only{i // 8}"] * 3 + ["the", "of", f"some{i % 16}"])) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    chunks = [c.asDict() for c in search.build_index(docs, str(tmp_path / "index")).collect()]
    assert len(chunks) == 1
    chunk = search.Chunk({name: pa.scalar(bytes(chunks[0][name])) for name in search.Chunk.READ})
    block = search.QueryBlock([rows[3][0], rows[90][0]], [np.unique(search.term_hashes(rows[i][1])) for i in (3, 90)])
    df = np.array([sum(h in search.term_hashes(t) for _, t in rows) for h in block.terms])
    block.weigh(df, len(rows))
    best = search.TopK(2, 3)
    search.score_chunk(chunk, block, 6.0, best)
    assert best.postings and not best.skipped
    first = best.score.copy()
    again = search.TopK(2, 3)
    again.least = best.least.copy()
    search.score_chunk(chunk, block, 6.0, again)
    assert 0 < again.skipped < again.postings == best.postings
    assert again.score.tolist() == first.tolist() and again.doc.tolist() == best.doc.tolist()


def test_blocks_are_bounded_while_that_pays():
    best, told = search.TopK(2, 3), []
    for chunk in range(1, 25):
        told.append(best.bounds())
        if told[-1]:
            best.postings, best.skipped = best.postings + 100, best.skipped + (50 if 10 <= chunk < 14 else 5)
    assert [i for i, t in enumerate(told, 1) if t] == [2, *range(10, 18), 18]


def test_search_odd_rows(spark):
    docs = D.make(spark)
    assert search.top_k(docs, docs, k=3).where("query_id = 2").count() == 0
    assert search.top_k(D.empty(spark), D.empty(spark)).count() == 0
    assert search.top_k(docs, docs.limit(0)).count() == 0


def test_search_in_groups_matches_brute_force(spark, monkeypatch):
    """Queries of two vocabularies, in small groups, with postings added a few at a time."""
    for name, value in {"COMMON": 5, "GROUP": 3, "LEAD": 6, "BLOCK": 4, "CHUNK_DOCS": 90, "FILE_CHUNKS": 1, "ADDED_POSTINGS": 11, "STEP_QUERIES": 2}.items():
        monkeypatch.setattr(search, name, value)
    rng = random.Random(5)
    vocabularies = [[f"{x}{int(rng.paretovariate(0.7))}" for _ in range(200)] for x in "ab"]
    rows = [(i, " ".join(rng.choice(vocabularies[i // 7 % 2]) for _ in range(rng.randint(1, 60)))) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = search.top_k(docs.repartition(2), docs.where(search.every_fiftieth(F.col("doc_id"))), k=10)
    assert sorted((r.query_id, r.doc_id, r["rank"]) for r in got.collect()) == brute_search(rows, [r for r in rows if r[0] % 50 == 0], 10)


def test_groups_have_common_terms_of_their_own(monkeypatch):
    monkeypatch.setattr(search, "COMMON", 3)
    monkeypatch.setattr(search, "GROUP", 8)
    texts = [f"{'the of and' if i % 2 else 'der von und'} rare{i}" for i in range(16)]
    block = search.QueryBlock(list(range(16)), [np.unique(search.term_hashes(t)) for t in texts])
    block.weigh(np.where(np.isin(block.terms, search.term_hashes("the of and der von und")), 500, 1), 1000)
    assert {frozenset(block.ids[a:b] % 2) for a, b, _, _ in block.groups} == {frozenset({0}), frozenset({1})}
    assert {frozenset(block.terms[c]) for _, _, c, _ in block.groups} == {frozenset(search.term_hashes("the of and")), frozenset(search.term_hashes("der von und"))}
    assert len(block.rows) == 16 and all(has.all() for *_, has in block.groups)


def test_chunks_are_cut_evenly_across_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "CHUNK_DOCS", 100)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        index = search.build_index(spark.createDataFrame([(i, f"a b w{i}") for i in range(210)], "doc_id long, text string").coalesce(1), str(tmp_path / "index"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(r.docs for r in index.collect()) == [70, 70, 70]


def test_a_null_id_is_last_among_equal_documents(spark):
    docs = spark.createDataFrame([(None, "one two")] + [(i, "one two") for i in range(1, 11)], "doc_id long, text string").coalesce(1)
    got = search.top_k(docs, docs.where("doc_id = 1"), k=10)
    assert [r.doc_id for r in got.orderBy("rank").collect()] == list(range(1, 11))


def test_a_step_changes_only_the_lists_of_its_queries():
    best = search.TopK(4, 2)
    best.add(np.array([1, 3, 1, 1]), np.array([1.0, 5.0, 3.0, 2.0]), np.array([7, 8, 9, 10]))
    best.add(np.array([1]), np.array([2.0]), np.array([-4]))
    assert best.doc.tolist()[1] == [9, -4] and best.doc[3, 0] == 8
    assert best.least.tolist() == [-np.inf, 2.0, -np.inf, -np.inf]


@pytest.mark.parametrize(("broadcast", "partners"), [(500_000, 64), (0, 2)])
def test_a_row_repeated_in_several_tasks_counts_once(spark, monkeypatch, broadcast, partners):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(jaccard, "PARTNERS", partners)
    rows = []
    for i, same in enumerate((60, 64, 68, 72, 75, 79, 84, 90, 97) * 3):  # of 100 shingles each; 90 of 110 is the first to link
        body = " ".join(f"b{i}x{j}" for j in range(same + 4))
        rows += [(10 * i + t, f"{body} " + " ".join(f"{x}{i}y{j}" for j in range(100 - same))) for t, x in enumerate("uv")]
    repeated = spark.createDataFrame([r for r in rows for _ in range(4)], "doc_id long, text string").repartition(6, F.rand(1))
    want, groups = brute_components(rows)
    got = jaccard.components(repeated).select("doc_id", "n", "component_id").distinct().collect()
    assert Counter(map(tuple, got)) == want
    if broadcast:
        assert jaccard.keep_one(repeated).count() == groups


def test_components_with_salted_lists_and_partners(spark, monkeypatch):
    for name, value in (("BROADCAST_ROWS", 0), ("PARTNERS", 2), ("LIST", 3), ("SEEN", 1), ("BATCH_BYTES", 100)):
        monkeypatch.setattr(jaccard, name, value)
    rows = near_copies()
    got = jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_components(rows)[0]


def test_many_rows_without_an_id(spark):
    rows = [(None, f"row {i} of many that have no id and this is {'odd' if i % 2 else 'even'} {i // 2}") for i in range(2000)]
    rows += [(None, " ".join(f"w{(i + j) % 120}" for j in range(100))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard.keep_one(docs).count() == brute_components(rows)[1]


PROSE = "<p>" + "A sentence of plain prose with enough words in it to be taken for text. " * 3 + "</p>"
KEPT = html.main_text(f"<article>{PROSE}</article>")


def test_elements_without_an_end_tag_cut_nothing():
    alone = ["<svg width=1 />", "<svg><style/><title/><path/></svg>", "<button>", "<video src='x' />", "<canvas>", "<template>", "<select>", "<math/>", "<svg><path d=x>", "<object data=x>"]
    for x in alone:
        page = f"<html><head><title>t</title></head><body><article>{PROSE}{x}{PROSE}</article></body></html>"
        assert html.main_text(page) == f"{KEPT}\n{KEPT}", x
    for head in ("<head><title>x</title>", "<head><title>x", "<head><meta a=b><script>'</head>'</script><style>p{}</style>", "<head><title>x</title><noscript><p>y</p></noscript>"):
        assert html.main_text(f"<html>{head}<body><article>{PROSE}</article>") == KEPT
        assert html.main_text(f"<html>{head}</head><article>{PROSE}</article>") == KEPT
    assert html.main_text(f"<head><title>x</title><article>{PROSE}</article>") == KEPT
    hidden = "<svg><title>a</title><text>b</text></svg><button><div>c</div></button><video>d<p>e</p></video><select><option>f</select><template><p>g</template>"
    assert html.main_text(f"<article>{PROSE}<p>One {hidden} two three four five.</p></article>") == f"{KEPT}\nOne two three four five."
    assert html.main_text(f"<article>{PROSE}<!-- <p>{PROSE} --><p>One<!-- a > b --> two three four five.</p><![CDATA[x]]></article>") == f"{KEPT}\nOne two three four five."


def test_a_name_on_the_wrapper_of_the_article_does_not_lose_it():
    comments = "<div class=comments><p>" + "I like this text very much, and so do all of my friends. " * 2 + "</p></div>"
    side = "<div class=sidebar><p>See also the other texts that we have on this site for you.</p></div>"
    for name in ("content has-sidebar", "search-result article-body", "print", "social share"):
        for tag in ("div", "section"):
            whole = f"<{tag} class='{name}'><h1>A title</h1>{PROSE}{PROSE}</{tag}>"
            assert html.main_text(f"<body><nav><a href=x>Menu</a></nav>{whole}{comments}<footer>f</footer></body>") == f"A title\n{KEPT}\n{KEPT}"
            assert html.main_text(f"<body><{tag} id='{name}'>{side}<article>{PROSE}{PROSE}</article>{comments}</{tag}></body>") == f"{KEPT}\n{KEPT}"
    assert html.main_text(f"<body>{''.join(f'<div class=print>{PROSE}</div>' for _ in range(4))}</body>") == "\n".join([KEPT] * 4)
    assert html.main_text(f"<body><article>{PROSE}{PROSE}{comments}</article>{side}</body>") == f"{KEPT}\n{KEPT}"
