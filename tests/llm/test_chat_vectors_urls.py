import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from proseframe.llm import chat, vectors
from proseframe.llm.chat import CONTROL, escape, escape_line, format_conversations, parse_turns, read_back, unescape
from proseframe.llm.template import Name, Show, TemplateError, Text, compile_template, fold, parse
from proseframe.llm.urlfilter import RULES, judge, spread
from proseframe.llm.vectors import multi_sequence, near_vectors


def rendered(source, **names):
    return "".join(t for t, _ in compile_template(source)(**names))


def test_language():
    assert rendered("a{# no #}{{ 1 + 2 * 3 }}{{ 'x' ~ none ~ true }}") == "a7xtrue"
    assert rendered("{% for m in ms %}{{ loop.index }}{{ m.a.b | default('-') | upper }}{% if not loop.last %},{% endif %}{% endfor %}", ms=[{"a": {"b": "x"}}, {}]) == "1X,2-"
    source = "{% if a == 1 %}one{% elif a in few %}few{% else %}{{ a if not a < 5 else 'some' }}{% endif %}"
    assert [rendered(source, a=a, few=[2]) for a in (1, 2, 3, 9)] == ["one", "few", "some", "9"]
    assert rendered("{% set x = 'n' | replace('n', '\\n') %}{{ x }}{%- if x %} y {%- endif -%} z") == "\n yz"
    pieces = list(compile_template("u{% generation %}{{ t }}!{% endgeneration %}v")(t="T"))
    assert pieces == [("u", False), ("T", True), ("!", True), ("v", False)]


def test_folding():
    assert fold(parse("a{{ 'b' | upper }}{% if 1 > 2 %}x{% elif true %}c{% endif %}{{ v }}")) == (Text("aBc"), Show(Name("v")))
    assert fold(parse("{{ v if 1 == 1 else 2 }}{{ 3 and v }}")) == (Show(Name("v")), Show(Name("v")))


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ _x }}", "{{ x() }}", "{{ x | system }}", "{% import os %}", "{% if x %}", "{% for x %}{% endfor %}", "{{ 'a' * 999999999 }}", "{{ 1 +", "{% endfor %}", "{{ 1 $ 2 }}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}"])
def test_sandbox(source):
    with pytest.raises(TemplateError):
        list(compile_template(source)(x="s"))
    assert rendered("{{ x.upper }}{{ x[9] }}", x="s") == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*CONTROL, "\\", "-", "n", "\n", "<", "|", "im_end", "|>", "é", "[", "]"]), max_size=12).map("".join))
def test_escape(text):
    assert unescape(escape(text)) == text == unescape(escape_line(text))
    assert not any(c in escape(text) for c in CONTROL) and "\n" not in escape_line(text)
    whole = f"<|im_start|>{escape_line(text)}\n{escape(text)}<|im_end|>\n" * 2
    for cut in (1, 7, len(whole)):
        assert list(parse_turns(whole[i : i + cut] for i in range(0, len(whole), cut))) == [(text, text)] * 2


def test_conversations(spark, monkeypatch):
    rows = [(1, 2, "assistant", "b <|im_end|>"), (1, 0, "system", None), (1, 1, "user", "a\\-"), (2, 0, "user", ""), (2, 0, None, "t"), (None, 0, "assistant", "n"), (3, None, "assistant", "x" * 3000), (3, 1, "assistant", "y"), (3, 1, "assistant", "y")]
    for part in (1 << 20, 500):
        monkeypatch.setattr(chat, "PART", part)
        data = spark.createDataFrame([(*r, 5) for r in rows], "conv_id bigint, turn int, role string, text string, part int")
        for again in (False, True):
            made = format_conversations(data)
            got = read_back(made, ordered=not again).collect()
            assert len(got) == 4
            for r in got:
                mine = sorted((t for t in rows if t[0] == r.conv_id), key=lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or "", t[3] or ""))
                said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine)
                learned = "".join(t[3] or "" for t in mine if t[2] == "assistant")
                assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(mine), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert read_back(format_conversations(data.limit(0))).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=6), st.lists(st.integers(0, 9), min_size=1, max_size=6), st.integers(0, 12))
def test_traversal(first, second, margin):
    first, second = np.array(first, dtype=float), np.array(second, dtype=float)
    got = list(multi_sequence(first, second, margin))
    sums = [first[i] + second[j] for i, j in got]
    near = first.min() + second.min() + margin
    assert sums == sorted(sums) and sorted(got) == sorted((i, j) for i in range(len(first)) for j in range(len(second)) if first[i] + second[j] <= near)


def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((60, 16))
    x = [c + s * rng.standard_normal(16) for c in centres for s in (0.05, 0.08, 0.1, 0.12, 0.5)]
    x += [x[3]] * 5 + [2 * x[7]] * 3 + [centres[0] + 0.02 * rng.standard_normal(16) for _ in range(80)]
    x = [np.asarray(v, dtype=np.float32).tolist() for v in x]
    x += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 8]
    ids = list(range(len(x)))
    x.append(x[0])
    ids.append(None)
    data = spark.createDataFrame([(i, v, 3) for i, v in zip(ids, x)], "vec_id bigint, embedding array<float>, n int").repartition(3)
    good = [i for i in range(len(x) - 8)]
    units = np.array([x[i] for i in good], dtype=float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    linked = units @ units.T >= 0.95
    label = np.arange(len(good))
    while (new := np.array([label[row].min() for row in linked])).tolist() != label.tolist():
        label = new
    for chunk in (2000, 7):
        monkeypatch.setattr(vectors, "CHUNK", chunk)
        got = {r.id: r for r in near_vectors(data, per_cell=20).collect()}
        assert len(got) == len(x)
        links = np.array([got[i].n_links for i in good])
        true = linked.sum(axis=1) - 1
        assert (links <= true).all() and links.sum() >= 0.97 * true.sum()
        if links.tolist() == true.tolist():
            assert [got[i].component_id for i in good] == label.tolist()
        assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in ids[-8:-1])
    assert near_vectors(data.limit(0)).count() == 0 and near_vectors(data.where("vec_id is null")).count() == 1


@pytest.mark.parametrize("most", [None, 64, 1])
def test_rare_links_across_cells(spark, monkeypatch, most):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 32))
    for i in range(10):
        at = rng.standard_normal(32)
        at -= x[i] * (at @ x[i]) / (x[i] @ x[i])
        x[2000 + i] = x[i] / np.linalg.norm(x[i]) + (0.3, 0.32)[i % 2] * at / np.linalg.norm(at)
    if most:  # too few queries to measure anything: the margin is that of planted neighbours
        monkeypatch.setattr(vectors, "MOST", most)
        monkeypatch.setattr(vectors, "CHUNK", 100)
    data = spark.createDataFrame([(i, v) for i, v in enumerate(x.astype(np.float32).tolist())], "vec_id bigint, embedding array<float>").repartition(3)
    got = {r.id: (r.n_links, r.component_id) for r in near_vectors(data, per_cell=10).collect()}
    assert got == {i: (1, i % 2000) if i % 2000 < 10 and i < 2010 else (0, i) for i in range(3000)}


def test_vectors_of_every_length(spark):
    rng = np.random.default_rng(7)
    rows, ids = [], 0
    for size, n in ((16, 40), (8, 11), (3, 2), (1, 3)):
        for v in rng.standard_normal((n, size)):
            rows += [(ids, v.tolist()), (ids + 1, (v * 2).tolist())]  # the same direction twice
            ids += 2
    data = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(2)
    got = {r.id: (r.n_links, r.component_id) for r in near_vectors(data).collect()}
    assert len(got) == ids
    for i, v in rows:
        x = np.array(v)
        mine = [j for j, w in rows if j != i and len(w) == len(v) and x @ w >= 0.95 * np.linalg.norm(x) * np.linalg.norm(w)]
        assert got[i] == (len(mine), min([i, *mine])), i


def test_planted_links_among_many(spark):
    """20,000 vectors and 200 planted links of cosines just above the threshold, in all directions: recall against all pairs."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((20_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(200):
        to = rng.standard_normal(32) * (np.arange(32) < 16 if i % 4 == 1 else np.arange(32) >= 16 if i % 4 == 2 else 1)
        to -= x[i] * (to @ x[i])
        c = rng.uniform(0.9501, 0.97)
        x[10_000 + i] = c * x[i] + np.sqrt(1 - c * c) * to / np.linalg.norm(to)
    truth = 0
    for at in range(0, len(x), 2000):
        truth += int((x[at : at + 2000] @ x.T >= 0.95).sum()) - len(x[at : at + 2000])
    data = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>").repartition(4)
    found = near_vectors(data).agg({"n_links": "sum"}).first()[0]
    assert truth >= 400 and 0.98 * truth <= found <= truth


def test_rules(spark):
    urls = [None, "", "no scheme", "http://x.ORG", "HTTP://x.org/es/1", "http://a.example.org/es/1", "https://example.org/en/1?x", "http://example.org/en/2#y", "http://myexample.org/es/", "a://b://c.com/fr/q?r", "http://com/de/", "http://x.com/de", "http://x.com/de/", "http://x.com/it", "http://u@h:80/p\nq?", "http://x.org?/"]
    pages = spark.createDataFrame([(i, u, None, "r") for i, u in enumerate(urls)], "page_id int, url string, html string, rule string")
    got = {r.page_id: r for r in judge(pages).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best.name if best else None), url
        assert got[i].verdict == best.verdict if best else got[i].verdict in ("allow", "block")
    assert judge(pages.limit(0)).count() == 0


def test_spread(spark):
    names = list("abcdef")
    links = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 1), ("d", "e", 3), ("f", "d", 1)]
    trust, distrust = {"a": 1.0, "f": 0.5}, {"e": 1.0}
    seeds = [(n, trust.get(n, 0.0), distrust.get(n, 0.0)) for n in names]
    m = np.zeros((6, 6))
    for s, d, n in links:
        m[names.index(d), names.index(s)] = n
    solve = lambda m, v: np.linalg.solve(np.eye(6) - 0.85 * m / np.maximum(m.sum(axis=0), 1), v)
    t, d = solve(m, np.array([s[1] for s in seeds])), solve(m.T, np.array([s[2] for s in seeds]))
    got = {r.host: r for r in spread(spark.createDataFrame(seeds, "host string, trust double, distrust double"), spark.createDataFrame(links, "src string, dst string, n bigint"), tolerance=2e-5).collect()}
    for i, n in enumerate(names):
        assert abs(got[n].trust - t[i]) < 1e-3 and abs(got[n].distrust - d[i]) < 1e-3


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    bad, good = [("http://bad.com/de/%d" % i, "") for i in range(20)], [("http://good.net/%d" % i, "x") for i in range(5)]
    farm = [("http://farm.net/%d" % i, '<a HREF="http://bad.com/x">y</a><a href=/local>z</a>') for i in range(6)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(bad + good + farm)], "page_id int, url string, html string")
    said = {r.host: r.verdict for r in judge(pages).collect()}
    assert said == {"bad.com": "block", "good.net": "allow", "farm.net": "block"}


def test_distrust_reaches_hosts_of_one_domain(spark):
    """No page links anywhere: what is known of a site's hosts decides on its other hosts."""
    urls = [f"http://a.bad.com/de/{i}" for i in range(9)] + ["http://b.bad.com/x", "http://c.b.bad.com/"]
    urls += [f"http://a.good.com/fr/{i}" for i in range(9)] + ["http://b.good.com/x"] + [f"http://{p}.mixed.com/{p}/{i}" for p in ("fr", "de") for i in range(9)]
    urls += ["http://b.mixed.com/x", "http://lone.net/", "http://..com/x", "http://com/"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id int, url string, html string")
    said = {r.host: r.verdict for r in judge(pages).where("rule is null").collect()}
    assert said == {"b.bad.com": "block", "c.b.bad.com": "block", "b.good.com": "allow", "b.mixed.com": "allow", "lone.net": "allow", "..com": "allow", "com": "allow"}


def test_domain_links(spark):
    from proseframe.llm.urlfilter import domain_links

    hosts = spark.createDataFrame([("x.a.b.com", 3), ("y.a.b.com", 2), ("b.com", 7), ("com", 1), ("", 1), (None, 1), ("a..com", 1)], "host string, n bigint")
    got = {(r.src, r.dst): r.n for r in domain_links(hosts).collect()}
    up = {("x.a.b.com", "a.b.com"): 3, ("y.a.b.com", "a.b.com"): 2, ("a.b.com", "b.com"): 5}
    assert got == up | {(b, a): n for (a, b), n in up.items()}


def test_spread_that_does_not_settle_is_an_error(spark):
    seeds = spark.createDataFrame([("a", 1.0, 0.0)], "host string, trust double, distrust double")
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n bigint")
    with pytest.raises(RuntimeError, match="settle"):
        spread(seeds, links, rounds=2)
