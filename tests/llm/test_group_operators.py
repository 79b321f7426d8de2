import collections
import itertools
import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from titrant.llm import chat, html_extract, html_tree, minhash, url_filter
from titrant.llm.bytewords import slices
from titrant.llm.components import components


def brute_classes(rows, weights):
    """Least id of each class, by all pairs of the operator's own vectors (so that words that share a bucket weigh alike)."""
    vectors = []
    for part in slices(pa.array([t for _, t in rows], pa.string())):
        r, ids, w, *_ = minhash.vectors(part, weights)
        edge = np.searchsorted(r, np.arange(part.n + 1))
        vectors += [(ids[edge[i] : edge[i + 1]], w[edge[i] : edge[i + 1]]) for i in range(part.n)]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if len(vectors[i][0]) and len(vectors[j][0]) and minhash.weighted_jaccard(vectors[i], vectors[j]) >= minhash.THRESHOLD:
            parent[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return sorted((d, min(least[find(i)])) for i, (d, _) in enumerate(rows))


@pytest.fixture(scope="module")
def near_copies(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows, n = [], 0
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 12, 60, 150]))]
        for _ in range(rng.choice([1, 3, 20])):
            t = list(base)
            for _ in range(rng.randint(0, 2 + len(base) // 60)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            rows.append((n, " ".join(t).upper() if n % 3 else " - ".join(t)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "!!"), (n + 3, None)]
    return rows


def test_minhash_classes(spark, near_copies):
    frame = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(3)
    got = minhash.classes(frame).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute_classes(near_copies, minhash.word_weights(frame))
    per_class = collections.Counter(r.class_id for r in got if r.kept)
    assert set(per_class) == {r.class_id for r in got} and set(per_class.values()) == {1}


def test_minhash_verifies_whole_buckets(spark, monkeypatch):
    """Texts of common passages share large buckets; what neither hub nor neighbours link is found all the same, in any blocks."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passages = [" ".join(word() for _ in range(12)) for _ in range(24)]
    rows = []
    for _ in range(12):
        base = rng.sample(range(24), 13)
        for _ in range(10):
            mix = list(base)
            for _ in range(rng.randint(0, 3)):
                mix[rng.randrange(len(mix))] = rng.randrange(24)
            rows.append((len(rows), " ".join(passages[k] for k in mix)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_classes(rows, minhash.word_weights(frame))
    monkeypatch.setattr(minhash, "neighbours", lambda labelled: labelled.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b")))
    for block in (256, 4):
        monkeypatch.setattr(minhash, "BLOCK", block)
        assert sorted((r.doc_id, r.class_id) for r in minhash.classes(frame).collect()) == want


def test_links_beyond_hub_and_neighbours(spark):
    """Two like texts five apart in one bucket whose hub is unlike both."""
    texts = [" ".join(f"t{1 if i == 6 else i}w{k}" for k in range(40)) + (" end" if i == 6 else "") for i in range(8)]
    rows = [(i, t, len(t), [0] * minhash.SKETCH_LONGS, [1] + [100 + i] * (minhash.BANDS - 1)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "rid long, body string, size int, sketch array<long>, bands array<long>")
    members = spark.createDataFrame([(0, 1, i) for i in range(8)], "band int, h long, node long")
    got = minhash._roots(members, frame, np.ones((2, minhash.BUCKETS)), minhash.THRESHOLD).collect()
    assert {(r.node, r.root) for r in got} == {(1, 1), (6, 1)}


def test_hundreds_of_near_copies(spark):
    """Groups of copies round the threshold against a plain model of all pairs: the same classes at any number of partitions, and no link lost."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7)))
    rows = []
    for size, edits in ((300, 4), (150, 2), (60, 6), (40, 1)):
        base = [word() for _ in range(200)]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randint(0, edits)):
                t[rng.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t)))
    rows += [(len(rows) + i, " ".join(word() for _ in range(rng.randint(1, 80)))) for i in range(60)]
    rng.shuffle(rows)
    # words that share both buckets with others weigh less, which may move a similarity a little: no link well above the threshold may be lost, none well below it made
    (sure, links), (possible, _) = plain.near_classes(rows, 0.802), plain.near_classes(rows, 0.798)
    assert links > 20_000
    held = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts in ("4", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append(sorted((r.doc_id, r.class_id) for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert got[0] == got[1]
    together = lambda classes: [{d for d, _ in g} for _, g in itertools.groupby(sorted(classes, key=lambda x: (x[1], x[0])), key=lambda x: x[1])]
    mine, above = dict(got[0]), dict(possible)
    lost = sum(len({mine[d] for d in group}) - 1 for group in together(sure))
    assert lost == 0 and all(len({above[d] for d in group}) == 1 for group in together(got[0]))


def test_block_links_are_all_pairs():
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[k : k + 40]) for k in range(0, 20, 2)] + [" ".join(rng.sample(base, 40)) for _ in range(5)]
    weights = np.ones((2, minhash.BUCKETS))
    n, apart = len(texts), np.arange(len(texts))
    links = lambda mine: minhash.block_links(0, mine, apart, apart, np.zeros((n, minhash.BANDS), np.int64), pa.array(texts), weights, minhash.THRESHOLD)
    want = {d for d, c in brute_classes(list(enumerate(texts)), weights) if c == 0}
    assert len(want) == 10 and {x for link in links(np.zeros(n, int)) for x in link} == want
    assert all((a + b) % 2 for a, b in links(apart % 2)) and links(apart % 2)
    assert minhash.block_links(3, np.zeros(n, int), apart, apart, np.zeros((n, minhash.BANDS), np.int64), pa.array(texts), weights, minhash.THRESHOLD) == []


def test_minhash_edge_cases(spark, awkward, empty):
    assert minhash.classes(empty).count() == 0
    kept = minhash.keep_one(awkward.withColumn("kept", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "n_words", "kept"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "None"]  # 5, again 5, and 6 are one class
    names = ["__rid", "__k1", "__K2", "__bands", "c0", "own1", "node", "body", "Class_ID", "kept"]
    clash = awkward.select("doc_id", "text", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    kept = minhash.keep_one(clash)
    assert kept.columns == clash.columns and kept.count() == 7 and tuple(kept.first())[2:] == tuple(range(10))
    assert minhash.classes(clash, keep=clash.columns).columns == ["doc_id", "text", *names[:8], "class_id", "kept"]


def test_samples_estimate_similarity():
    """Equal samples are as frequent as the texts are similar."""
    rng = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.9):
        hits, true = [], []
        for _ in range(60):
            ids = rng.integers(0, 1 << 48, 200).astype(np.uint64)
            weights = rng.gamma(2, 1, 200) + 0.1
            cut = int(200 * (1 - share) / (1 + share) + 0.5)
            a, b = np.arange(0, 200 - cut), np.arange(cut, 200)
            got = minhash.samples(2, np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)]), np.concatenate([ids[a], ids[b]]), np.concatenate([weights[a], weights[b]]))
            hits.append((got[0] == got[1]).mean())
            order_a, order_b = np.argsort(ids[a]), np.argsort(ids[b])
            true.append(minhash.weighted_jaccard((ids[a][order_a], weights[a][order_a]), (ids[b][order_b], weights[b][order_b])))
        assert np.mean(hits) == pytest.approx(np.mean(true), abs=0.03)


def test_components(spark):
    links = [(i + 1, i) for i in range(25)] + [(100, j) for j in range(101, 140)] + [(7, 7), (300, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(26)} | {j: 100 for j in range(100, 140)} | {300: 200, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_url_filter(spark):
    rules = sorted(url_filter.HOST_RULES, key=lambda r: -len(r[0]))

    def plain(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0] if url and "://" in url else ""
        for rule, verdict in rules:
            h, p = rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                return host, path, rule, verdict
        return host, path, None, None

    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/71?x", "https://example.com/en/8#a", "x://b.com/a.com/en/", "http://net/de/", "http://evilnet/de/1", "http://example.net/de/8", "http://a.example.net/de/9", "https://q.org/es", "https://q.org/es/", "http://www.casino-win.example.org/en/", "http://É.org/es/1", "http://ads-track.io", "a://b?c://d.com/en/"]
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    got = url_filter.judge(frame).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        host, path, rule, verdict = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if "casino" in host or host == "ads-track.io" else "allow"))
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_verdicts_of_contract(spark, tmp_path):
    """Each rule's word is the contract's, in the rows and in the SQL."""
    import duckdb

    words = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
    urls = ["http://a.com/en/1", "http://a.example.com/en/71", "http://a.net/de/1", "http://example.net/de/9", "http://a.example.net/de/80", "http://a.org/es/", "http://casino.net/de/1"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(url_filter.query(spark, str(tmp_path)).collect())
    assert [r.rule for r in got] == ["com/en/", "example.com/en/7", "net/de/", "net/de/", "example.net/de/8", "org/es/", "net/de/"]
    assert all(r.verdict == words[r.rule] for r in got)
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
        assert sorted(c.execute(url_filter.sql()).fetchall()) == [tuple(r) for r in got]


def test_very_long_urls(spark):
    rows = [(1, "http://a.com/en/" + "x" * 200_000), (2, "http://" + "a." * 50_000 + "casino/" + "b/" * 50_000), (3, "x" * 100_000), (4, "http://b.org/" + "y" * 300_000 + ".exe")]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [(got[i].verdict, got[i].rule) for i in (1, 2, 3, 4)] == [("block", "com/en/"), ("block", None), ("allow", None), ("block", None)]
    assert got[1].path == rows[0][1][12:] and got[2].host == "a." * 50_000 + "casino"


def test_rule_table(spark):
    """Rules and globs from a table, in its order; a table that is too large for one automaton is refused before it is read."""
    table = spark.createDataFrame([("com/en/", "block", "host"), ("**/*.zip", "block", "glob"), ("b.com/en/", "allow", "host"), (None, None, None)], "rule string, verdict string, kind string")
    rules, globs = url_filter.read_rules(table)
    assert set(rules) == {("com/en/", "block"), ("b.com/en/", "allow")} and globs == ["**/*.zip"]
    frame = spark.createDataFrame([(1, "http://a.com/en/x"), (2, "http://a.b.com/en/x"), (3, "http://c.net/d.zip"), (4, "http://c.net/d")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(frame, host_rules=rules, globs=globs).collect()} == {1: "block", 2: "allow", 3: "block", 4: "allow"}
    with pytest.raises(ValueError):
        url_filter.read_rules(table, most=5)


def test_globs():
    import re

    rng = random.Random(1)
    globs = ["a*b", "**/x", "*.c/*", "ab", "*", "**", "a**", "*b*/**", "/"] + ["".join(rng.choice("ab/*") for _ in range(rng.randint(1, 9))).replace("***", "*") for _ in range(60)]
    texts = ["".join(rng.choice("ab/.cx") for _ in range(rng.randint(0, 9))) for _ in range(400)]
    machine = url_filter.GlobSet(globs)
    assert machine.width > 1
    (part,) = slices(pa.array(texts))
    got = machine.match(part)
    for i, t in enumerate(texts):
        assert got[i].tolist() == [bool(re.fullmatch("".join({"**": ".*", "*": "[^/]*"}.get(x, re.escape(x)) for x in url_filter._parts(g)), t)) for g in globs], t


def cheapest(roles):
    """All repairs, by trying every step in every state."""
    best = {chat.START: 0}
    for given in roles:
        now = {}
        for state, cost in best.items():
            for role in range(3):
                change = 0 if role == given else chat.UNKNOWN if given == 3 and role > 0 else chat.RELABEL
                options = [change] if role in chat.NEXT[state] else []
                options += [change + chat.MERGE] if state == 1 + role else []
                options += [change + chat.INSERT for q in chat.NEXT[state] if role in chat.NEXT[1 + q]]
                for c in options:
                    now[1 + role] = min(now.get(1 + role, 1 << 40), cost + c)
        best = now
    return min(best.values())


def test_repair_is_cheapest_and_legal():
    rng = random.Random(2)
    for _ in range(1500):
        roles = [rng.randint(0, 3) for _ in range(rng.randint(1, 10))]
        steps = chat.repair(roles)
        assert sum(s[0] for s in steps) == cheapest(roles)
        state = chat.START
        for _, action, role, inserted in steps:
            if inserted >= 0:
                assert inserted in chat.NEXT[state]
                state = 1 + inserted
            assert state == 1 + role if action == "merge" else role in chat.NEXT[state]
            state = 1 + role
        cut = rng.randint(0, len(roles))
        assert chat.compose(chat.cost_matrix(roles[:cut]), chat.cost_matrix(roles[cut:])) == chat.cost_matrix(roles)


def test_split_conversations(spark):
    """One conversation over several partitions is repaired as if it were in one place."""
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant", "system", "tool", None]), "x") for t in range(2500)]
    rows += [(c, t, rng.choice(["user", "assistant"]), None) for c in range(40) for t in range(rng.randint(1, 5)) if c != 7]
    got = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.turn):
        by[r.conv_id].append(r)
    for c, turns in by.items():
        roles = [chat.role_number(r) for _, _, r, _ in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        assert [(r.cost, r.action, r.new_role) for r in turns] == [(s[0], s[1], chat.ROLES[s[2]]) for s in chat.repair(roles)]


def test_pieces_by_a_plain_model(spark):
    """Renderings of short conversations against trying every sequence."""
    rng = random.Random(12)
    rows, talks = [], {}
    for c in range(300):
        talks[c] = [(rng.choice(["system", "user", "assistant", "tool", None, ""]), rng.choice(["a", "", None, "two\nlines", "x" * 5000])) for _ in range(rng.randint(1, 7))]
        rows += [(c, t, *turn) for t, turn in enumerate(talks[c])]
    got = collections.defaultdict(list)
    for r in sorted(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)).collect(), key=lambda r: (r.conv_id, r.turn)):
        got[r.conv_id].append(r)
    for c, turns in talks.items():
        best = plain.chat_rendering(turns)
        least = min(cost for cost, _ in best.values())
        assert sum(r.cost for r in got[c]) == least
        shown = "".join(r.piece for r in got[c])
        if sum(cost == least for cost, _ in best.values()) == 1 and len(turns) == 1:
            assert shown == next(s for cost, s in best.values() if cost == least)
        # legal, with all texts in order, whichever of the cheapest it is
        roles = [line[2:-2] for line in shown.split("\n") if line in ("<|system|>", "<|user|>", "<|assistant|>")]
        state = None
        for role in roles:
            assert role in {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}[state]
            state = role
        assert "".join(x for x in shown.split("\n") if x not in ("<|system|>", "<|user|>", "<|assistant|>")) == "".join((t or "").replace("\n", "") for _, t in turns)


def test_very_long_turns(spark):
    rows = [(1, 0, "user", "u" * 3_000_000), (1, 1, "user", "v" * 10), (1, 2, "assistant", "w" * 2_000_000)]
    got = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("turn").collect()
    assert [len(r.piece) for r in got] == [3_000_000 + 10, 11, 2_000_000 + 15]


def test_chat_edge_cases(spark):
    schema = "conv_id long, turn long, role string, text string, piece int"
    rows = [(None, None, None, None, 1), (1, 0, "user", "a", 1), (1, 0, "user", "a", 1), (1, 1, "assistant", "b", 1)]
    got = chat.format_turns(spark.createDataFrame(rows, schema)).orderBy("conv_id", "turn", "action").collect()
    assert [(r.conv_id, r.action, r.piece) for r in got] == [(None, "relabel", "<|user|>\n\n"), (1, "keep", "<|user|>\na\n"), (1, "merge", "a\n"), (1, "keep", "<|assistant|>\nb\n")]
    assert chat.format_turns(spark.createDataFrame([], schema)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><aside>side</aside>
<div id=wrap><div class="story"><h1>{title}</h1><p>First &amp; {n}<br>line<p><b>Second {n}<!-- c --><p>Same everywhere<div class="x1">Join our club</div></div></div><form><input></form><section class="comments"><p>nice {n}</p></section><script>var a="</p>";</script><footer>&copy;</footer></body></html>"""


def test_extraction_by_wrapper(spark):
    rows = [(i, f"http://h.org/{i}", PAGE.format(title=f"Title {i}", n=f"{i} " + "word " * (10 + i % 5))) for i in range(20)]
    rows += [(100, "http://solo.org/", PAGE.format(title="Only", n="x")), (101, None, None), (102, "http://a.org/", ""), (103, "http://a.org/", "<article><h1>A<p>b&nbsp;&lt; c</article><p>out"), (104, "http://a.org/", "plain  <b>te</b>xt &am"), (105, "http://h.org/", "<div>" * 3000 + "deep")]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.main_text(frame).collect()}
    words = lambda i: " ".join(f"{i} {'word ' * (10 + i % 5)}".split())
    for i in range(20):  # a box that all pages of the host have is template, a paragraph that all articles have isn't
        assert got[i].text == f"Title {i}\nFirst & {words(i)} line\nSecond {words(i)}\nSame everywhere"
    assert got[100].text == "Only\nFirst & x line\nSecond x\nSame everywhere\nJoin our club"
    assert (got[101].text, got[101].n_chars, got[102].text) == ("", 0, "")
    assert got[103].text == "A\nb < c" and got[104].text == "plain text &am" and got[105].text == "deep"
    assert html_extract.main_text(frame.limit(0)).count() == 0


def test_join_instead_of_broadcast(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.org/{i}", PAGE.format(title=f"Title {i}", n=f"{i} words here")) for i in range(40)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(map(tuple, html_extract.main_text(frame).collect()))
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, html_extract.main_text(frame).collect())) == want


def test_copies_of_one_article_keep_it(spark):
    rows = [(i, f"http://c.org/{i}", f"<nav>n{i}</nav><article><h1>T</h1><p>same text all over</p><p>{'end' if i % 9 else 'fin'}</p></article>") for i in range(18)]
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"T\nsame text all over\nend", "T\nsame text all over\nfin"}


OPENING = "Opening {0} of a story that goes on for some time, as number {0} does, with more to say than what all of them say"


def unmarked(i, second=False):
    """A page whose boilerplate nothing names: menu, banner, club and imprint are told by being the same everywhere."""
    story = f"<h1>T{i}</h1><p>{OPENING.format(i)}</p><p>We always say this</p><div class=q><b>Join</b> our club<ul><li>now</li></ul></div><p>Close {i * i}</p>"
    if second:
        return f"<html><body><table><tr><td class=k><ul><li>Home<li>About</ul><td class=m>{story}</table></body></html>"
    return f"<html><body><div class=a><ul><li>Home<li>About</ul></div><div class=b><div class=c>{story}</div><div class=d>Imprint and law</div></div></body></html>"


def test_template_without_telling_names(spark):
    """Two layouts on one host, each with a wrapper of its own; and a host too small for any, whose pages keep all text."""
    rows = [(i, f"http://u.org/{i}", unmarked(i, i % 3 == 0)) for i in range(30)] + [(100 + i, f"http://v.org/{i}", unmarked(i)) for i in range(2)]
    frame = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string").repartition(4)
    got = html_extract.main_text(frame).collect()
    assert len(got) == 33
    for r in got:
        i = r.page_id % 100
        if r.page_id < 100:
            assert r.text == f"T{i}\n{OPENING.format(i)}\nWe always say this\nClose {i * i}" and r.n_chars == len(r.text)
        else:
            assert r.text == f"Home\nAbout\nT{i}\n{OPENING.format(i)}\nWe always say this\nJoin our club\nnow\nClose {i * i}\nImprint and law"


STORY = "<article><h1>Title</h1><p>the story goes on and on for some words</p>{}</article>"


@pytest.mark.parametrize("name", ["site-content has-sidebar", "no-sidebar", "search-results-page", "content-sidebar", "hasSidebar", "widget", "header"])
def test_boxes_with_the_article_stay(name):
    """Names that say what else is there, and names of boxes that hold nearly all text."""
    for held in (STORY.format(""), STORY.format("").replace("article>", "div>")):
        page = f"<body><div class='site-footer'>imprint</div><div id=page class='{name}'>{held}</div><ul class=navMain><li>Home</ul></body>"
        assert html_extract.extract(page) == "Title\nthe story goes on and on for some words"


def test_names_are_judged_whole():
    kept = ["related-work", "copyright-law", "search-results-page", "share-price", "comments-open", "no-ads", "post-header"]
    gone = ["ad", "ad-300x250", "AdBox", "cookieBanner", "comment-list", "related-posts", "sidebar-left", "site_footer", "menu__item", "x share-buttons", "top-nav"]
    for names, tail in ((kept, "\nmore"), (gone, "")):
        for name in names:
            assert html_extract.extract(STORY.format(f"<section class='{name}'>more</section>")) == "Title\nthe story goes on and on for some words" + tail, name
    long = "".join(f"<article class=comment><h3>c{i}</h3><p>{'words ' * 30}</p></article>" for i in range(9))  # comments may be most of a page
    assert html_extract.extract(f"<body><div class='comments has-replies'>{long}</div><div>{STORY.format('')}</div></body>") == "Title\nthe story goes on and on for some words"
    assert html_extract.extract("<div class=ad>" * 4000 + "<h1>a</h1>" + "<div class=ad>" * 4000 + "b") == "a"


def test_article_in_a_marked_box_with_a_wrapper(spark):
    rows = [(i, f"http://b.org/{i}", f"<body><div class=menu>Home</div><div class='site has-sidebar'><div>{OPENING.format(i)}</div><h1>T{i}</h1><p>{OPENING.format(i)}</p></div><div class=z><ul><li>Imprint</ul></div></body>") for i in range(20)]
    got = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{OPENING.format(i)}\nT{i}\n{OPENING.format(i)}" for i in range(20)}


def test_extraction_against_known_articles(spark):
    """Pages put together from parts at random: the text is the article's parts, whatever is around them."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    words = lambda n: " ".join(word() for _ in range(n))
    noise = ["<nav><ul><li>{}</ul></nav>", "<div class='ad top'>{}</div>", "<aside>{}<p>{}</aside>", "<footer>{}</footer>", "<form><p>{}</form>", "<script>var x = '{}'</script>", "<!-- {} -->", "<div id=comments><p>{}</div>", "<header><h2>{}</h2></header>", "<style>{}</style>"]
    rows, want = [], {}
    for i in range(120):
        blocks = [words(rng.randint(2, 30)) for _ in range(rng.randint(1, 6))]
        body = "".join(f"<h1>{blocks[0]}</h1>" if k == 0 else rng.choice(["<p>{}</p>", "<p>{}", "<blockquote>{}</blockquote>", "<ul><li>{}</ul>", "<p><b>{}</b></p>"]).format(b.replace(" ", rng.choice([" ", " \n ", " <i></i> ", "&#32;", "<br>"]))) for k, b in enumerate(blocks))
        around = lambda: "".join(x.replace("{}", words(3)) for x in rng.sample(noise, rng.randint(0, 4)))
        rows.append((i, f"http://h{i % 7}.org/", f"<html><head><title>{words(3)}</title></head><body>{around()}<article>{body}{noise[1].replace('{}', words(2))}</article>{around()}</body>"))
        want[i] = "\n".join(blocks)
    got = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_more_articles_than_the_reference_has(spark):
    page = lambda i, n: "<body><nav>n</nav>" + "".join(f"<article><h1>a{i} {k}</h1><p>text {i} {k}</p></article>" for k in range(n)) + "</body>"
    rows = [(i, f"http://w.org/{i}", page(i, 1 + (i % 5 == 0))) for i in range(20)]
    got = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "\n".join(f"a{i} {k}\ntext {i} {k}" for k in range(1 + (i % 5 == 0))) for i in range(20)}


def test_very_long_page(spark):
    rows = [(i, "http://long.org/", "<article>" + "".join(f"<p>{i} {k}</p>" for k in range(20_000 + i)) + "</article>") for i in range(4)]
    got = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "\n".join(f"{i} {k}" for k in range(20_000 + i)) for i in range(4)}


def best_matching(a, b, i=0, j=0):
    """Simple tree matching as it is defined, without any shortcut."""
    if a.labels[i] != b.labels[j]:
        return 0
    x, y = a.kids[i], b.kids[j]
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for p in range(len(x)):
        for q in range(len(y)):
            m[p + 1][q + 1] = max(m[p][q + 1], m[p + 1][q], m[p][q] + best_matching(a, b, x[p], y[q]))
    return 1 + m[-1][-1]


def test_matching_of_many_children_is_exact(monkeypatch):
    """The divided programme scores as the whole one, on small trees and on pages with hundreds of children."""
    rng = random.Random(8)

    def tree(n):
        some = ["<h2>x</h2>", "<ul><li>x</li></ul>", "<ul><li>x</li><li><p>y</p></li></ul>", "<p>x</p>", "<figure><img><p>z</p></figure>", "<p>x</p><p>y</p>"]
        return "<body>" + "".join(rng.choice(some) for _ in range(n)) + "</body>"

    flat = lambda page: html_tree.Flat(html_tree.parse(page))
    long = [tree(260) for _ in range(2)]
    for a, b in [(tree(rng.randint(1, 14)), tree(rng.randint(1, 14))) for _ in range(60)] + [(long[0], long[1]), (long[0], "<body>" + "<section><h3>n</h3></section>" * 60 + long[0][6:])]:
        a, b = flat(a), flat(b)
        monkeypatch.setattr(html_tree, "PAIRS_MOST", 10**9)
        whole = html_tree.match(a, b)[0]
        for most in (4, 40_000):
            monkeypatch.setattr(html_tree, "PAIRS_MOST", most)
            score, pairs = html_tree.match(a, b)
            assert score == len(pairs) == len(set(pairs)) == whole
            assert all(a.labels[i] == b.labels[j] for i, j in pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == score
            up = [{k: i for i, kids in enumerate(t.kids) for k in kids} for t in (a, b)]
            mine = dict(pairs)
            assert all(mine[up[0][i]] == up[1][j] for i, j in pairs if i)
            assert all(sorted(js) == js for kids in a.kids for js in [[mine[k] for k in kids if k in mine]])


def test_tree_matching():
    rng = random.Random(4)

    def page(depth=0):
        return "".join(f"<{t}>{page(depth + 1) if depth < 3 and t == 'div' else 'x'}</{t}>" for t in rng.choices(["div", "section", "h2"], k=rng.randint(0, 4)))

    for _ in range(150):
        a, b = html_tree.Flat(html_tree.parse(page())), html_tree.Flat(html_tree.parse(page()))
        score, pairs = html_tree.match(a, b)
        assert score == len(pairs) == best_matching(a, b)
        assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs) and all(a.labels[i] == b.labels[j] for i, j in pairs)
        assert html_tree.match(a, a)[0] == len(a.labels)


def test_pages_of_any_depth():
    """What holds under ten elements holds under ten thousand."""
    for depth in (10, 160, 20_000):
        page = "<div>" * depth + "<nav>MENU</nav><p>text</p>" + "</div>" * depth
        assert html_extract.extract(page) == "text"
        other = page.replace("text", "words") + "<footer>f</footer>"
        a, b = html_tree.Flat(html_tree.parse(page)), html_tree.Flat(html_tree.parse(other))
        assert html_tree.match(a, b)[0] == len(a.labels)
    assert html_extract.extract("<i><x>" * 5000 + "</q>" * 5000 + "<p>a" * 3000) == "\n".join("a" * 3000)
