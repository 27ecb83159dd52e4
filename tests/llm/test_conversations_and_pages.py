"""op11 to op13 against brute force, and their parts by hand."""

import hashlib
import itertools
import os
import random
import re
import zlib
from html import unescape

import duckdb
import pytest

from lociq.llm import html_text, queries, repair, turn_trie
from tests.oracle import connect

SF = "/root/testdata/sf0.001"
CLASHING = ", digest string, part int, ids int, whole boolean, top long"


def odd_rows(n, seed):
    """Turns with nulls everywhere, ties, repeats, a conversation with half of all rows, unknown roles, negative ids."""
    rnd = random.Random(seed)
    texts = ["Hi.", "Yes!", "Well", "?", None, "", " ", "ok. ", "é…", "Good.", "\x0b\t", "wörd. 🙂", "x" * 5000 + "."] + [f"say {i}." for i in range(5)]
    rows = []
    for _ in range(n):
        conv = rnd.choice([None, 0, 1, 2, 100, 101, 102, 250, 7, -5]) if rnd.random() < 0.5 else 3
        rows.append((conv, rnd.choice([None, *range(18)]), rnd.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]), rnd.choice(texts)))
    return rows


def written(spark, folder, rows):
    df = spark.createDataFrame([(*r, "clash", 1, 2, True, 3) for r in rows], "conv_id long, turn long, role string, text string" + CLASHING)
    df.repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def turns_of(sf_dir):
    path = f"{sf_dir}/conversations.parquet"
    return duckdb.sql(f"select conv_id, turn, role, text from '{path + '/*.parquet' if os.path.isdir(path) else path}'").fetchall()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sql_rows(con, name, columns):
    return sorted((tuple(r) for r in con.sql(queries.oracle_sql()[name]).select(*columns).fetchall()), key=str)


# ---------------------------------------------------------------- 11 repair

def all_repairs(turns, faults):
    """The best (cost, audit, lines) by trying every edit of every turn, with up to two inserts in each gap."""
    best = None

    def legal(roles):
        return re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "-" for r in roles)) is not None

    def go(i, cost, audit, said):
        nonlocal best
        if cost > (best[0] if best else 40):
            return
        for n in range(3):
            for added in itertools.product(("user", "assistant"), repeat=n):
                now, lines = cost + 3 * n, said + [(r, "") for r in added]
                if i == len(turns):
                    if legal([r for r, _ in lines]) and (best is None or (now, audit + "I" * n) < best[:2]):
                        best = (now, audit + "I" * n, lines)
                    continue
                role, text = turns[i]
                go(i + 1, now + 4, audit + "I" * n + "D", lines)
                if faults[i] not in ("blank", "duplicate"):
                    extra = 3 if faults[i] == "truncated" else 0
                    go(i + 1, now + extra, audit + "I" * n + "K", [*lines, (role, text)])
                    for new in ("user", "assistant"):
                        go(i + 1, now + extra + 3, audit + "I" * n + "R", [*lines, (new, text)])

    go(0, 0, "", [])
    return best


def faults_of(turns):
    out, seen = [], set()
    for role, text in turns:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def test_cheapest_edits_are_those_of_trying_all():
    rnd = random.Random(3)
    for _ in range(60):
        turns = [(rnd.choice(["user", "assistant", "system", "tool", ""]), rnd.choice(["Hi.", "No", "", "Yes!", "Hi."])) for _ in range(rnd.randrange(5))]
        faults = faults_of(turns)
        letters = "".join(repair.turn_class(r[:1], f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(turns, faults, strict=True))
        cost, labels, states = repair.cheapest(letters)
        want = all_repairs(turns, faults)
        assert (cost, "".join(labels)) == want[:2]
        roles, texts = repair.render(repair.START, "".join(labels), [r for r, _ in turns], [t for _, t in turns], [1] * len(turns))
        assert list(zip(roles, texts, strict=True)) == want[2] and states[0] == repair.START


def test_copies_count_as_turns():
    letters, *counts = repair.told_faults("uxAu", [3, 2, 1, 2], {3})
    assert letters == "uxxxxAxx" and counts == [2, 4, 1]


def brute_repair(rows):
    conv = {}
    for c, t, r, x in rows:
        turns = conv.setdefault(c, [])
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x
        turns += [(t, "user" if fate == 4 else r, x)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = []
    for c, v in conv.items():
        v.sort(key=lambda z: ((z[0] is not None, z[0] or 0), hashlib.sha256(f"{z[1]}:{z[2]}".encode()).digest()))
        known = {t for t, _, _ in v if t is not None}
        faults = faults_of([z[1:] for z in v])
        cur = insert_turns({"0": (0, "", ())})
        for (_, r, x), f in zip(v, faults, strict=True):
            new = {}

            def put(state, *weight, new=new):
                new[state] = min(new.get(state, weight), weight, key=lambda w: w[:2])

            for g, (cost, audit, lines) in cur.items():
                put(g, cost + 4, audit + "D", lines)
                if f in ("", "truncated"):
                    extra, to = 3 if f else 0, "a" if g == "u" else "u"
                    if r[:1] in {"0": "su", "s": "u", "u": "a", "a": "u"}[g] and r:
                        put(r[0], cost + extra, audit + "K", (*lines, f"{r}:{x}"))
                    put(to, cost + extra + 3, audit + "R", (*lines, f"{'user' if to == 'u' else 'assistant'}:{x}"))
            cur = insert_turns(new)
        cost, audit, lines = min((w for g, w in cur.items() if g in "0a"), key=lambda w: w[:2]) if v else (0, "", ())
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(v))
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out.append((c, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def insert_turns(cur):
    for _ in range(3):
        for g, (cost, audit, lines) in list(cur.items()):
            to = "a" if g == "u" else "u"
            new = (cost + 3, audit + "I", (*lines, "assistant:" if to == "a" else "user:"))
            cur[to] = min(cur.get(to, new), new, key=lambda w: w[:2])
    return cur


@pytest.mark.parametrize(("rows", "piece"), [(60, 512), (1500, 512), (1500, 7)])
def test_repair_is_brute_force(spark, tmp_path, monkeypatch, rows, piece):
    monkeypatch.setattr(repair, "PIECE_TURNS", piece)  # the workers' own copy has the usual size; conversations at a task's ends are cut all the same
    sf = written(spark, tmp_path, odd_rows(rows, rows))
    got = queries.op11_repair(spark, sf)
    assert rows_of(got) == brute_repair(turns_of(sf)) == sql_rows(connect_one(sf), "op11_repair", got.columns)


def connect_one(sf):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{sf}/conversations.parquet/*.parquet'")
    return con


def test_repair_of_the_tables(spark):
    got = queries.op11_repair(spark, SF)
    assert rows_of(got) == brute_repair(turns_of(SF)) == sql_rows(connect(SF), "op11_repair", got.columns)


def test_pieces_join_up_as_one_conversation():
    """Pieces of any length of one conversation give the audit of the whole."""
    rnd = random.Random(1)
    for _ in range(50):
        letters = [rnd.choice("suaoxSUAO") for _ in range(30)]
        cut = sorted(rnd.sample(range(1, 30), 4))
        parts = [letters[a:b] for a, b in zip([0, *cut], [*cut, 30], strict=True)]
        n = len(parts)
        got = repair._solve({"conv_id": [1] * n, "part": [0] * n, "seq": list(range(n)), "letters": ["".join(p) for p in parts], "initials": ["u" * len(p) for p in parts], "turns": [[i] for i in range(n)], "copies": [[1] * len(p) for p in parts], "later": [None] * n})
        cost, labels, _ = repair.cheapest("".join(letters))
        assert "".join(got["audit"]) == "".join(labels) and got["cost"][0] == cost and sum(got["illegal"]) == 29


# ---------------------------------------------------------------- 12 trie

def brute_trie(rows):
    conv = {}
    for c, t, r, x in rows:
        if c is not None:
            conv.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [z[1:] for z in sorted(v, key=lambda z: (z[0], hashlib.sha256(f"{len(z[1])}:{z[1]}{z[2]}".encode()).digest()))] for c, v in conv.items()}
    made = {c: own.get(c - c % 100, [])[: (h := zlib.crc32(str(c).encode()) % 6)] + v[h:] for c, v in own.items()}
    nodes, kids = {}, {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        m, k = nodes[p], kids.get(p, [])
        leaves[p] = sum(leaves[q] for q in k) if k else 1
        saved[p] = sum(saved[q] for q in k) + ((len(m) - 1) * len(p[-1][1]) if p else 0)
        ends = ",".join(str(c) for c in sorted(m) if len(made[c]) == len(p))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(k), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("rows", "local"), [(60, 2000), (1500, 2000), (1500, 40), (300, 1)])
def test_trie_is_brute_force(spark, tmp_path, rows, local):
    """Whatever the size at which the recursion hands over to one task."""
    sf = written(spark, tmp_path, odd_rows(rows, rows) + [(i, i % 3, "user", "the same") for i in range(500, 560)])
    got = turn_trie.trie_nodes(turn_trie.rebuilt(spark.read.parquet(f"{sf}/conversations.parquet")), local_turns=local)
    assert rows_of(got) == brute_trie(turns_of(sf))


def test_trie_of_the_tables_and_its_sql(spark, tmp_path):
    got = queries.op12_turn_trie(spark, SF)
    assert rows_of(got) == brute_trie(turns_of(SF)) == sql_rows(connect(SF), "op12_turn_trie", got.columns)
    sf = written(spark, tmp_path, odd_rows(400, 9))
    assert rows_of(queries.op12_turn_trie(spark, sf)) == sql_rows(connect_one(sf), "op12_turn_trie", got.columns)


def test_copies_of_one_conversation_are_one_string(spark, tmp_path):
    turns = [(c, t, "user", f"turn {t}") for c in range(1, 90) for t in range(6)] + [(100, None, None, None)]
    sf = written(spark, tmp_path, turns)
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    strings = turn_trie.distinct_strings(turn_trie.turn_lists(table)).collect()
    assert sorted((r.rep, r.n) for r in strings) == [(1, 89), (100, 1)]
    assert rows_of(turn_trie.trie_nodes(turn_trie.turn_lists(table), local_turns=1))[0][3] in (89, 90)


# ---------------------------------------------------------------- 13 main text

def test_articles_of_the_tables(spark):
    """Headings and paragraphs of the article element, found by a plain pattern."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op13_tag_paths(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.DOTALL)[1]
        parts = [" ".join(unescape(re.sub(r"<br>|</?b>", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", inner)]
        assert r.text == "\n\n".join(filter(None, parts)) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_sql_of_main_text(spark):
    got = queries.op13_tag_paths(spark, SF)
    assert rows_of(got) == sql_rows(connect(SF), "op13_tag_paths", got.columns)


LONG = "This is a long paragraph, with commas, and a full stop. It goes on for a while, as they do."
PAGES = {
    "nothing marked": (f"<div id=top><a href=/>Home</a> <a href=/x>News</a></div><div><h1>A title</h1><p>{LONG}</p><h2>Part</h2><ul><li>one<li>two</ul><p>{LONG}</p><p>Short.</p></div><div>Copyright 2020</div>", ["A title", LONG, "Part", "one", "two", LONG, "Short."]),
    "boilerplate inside": ("<header><h1>Site</h1></header><main><h1>T</h1><p>Text</p><aside>side</aside><div class='share-box'>Tweet</div><section id=comments><p>Nice, indeed!</p></section><form>Mail</form><footer>by</footer></main>", ["T", "Text"]),
    "hints": (f"<div class='cookie-notice'>{LONG}</div><div class=adBanner>{LONG}</div><div role=navigation>{LONG}</div><p hidden>{LONG}</p><p style='display: none'>{LONG}</p><article>x</article>", ["x"]),
    "layout classes": ("<body class=sidebar><div class='page has-sidebar'><div class=widget><article>Hello <span class=ad>buy</span><b>World</b>!</article></div></div>", ["Hello World!"]),
    "references": ("<article>a &lt;b&gt; &amp;amp; &eacute;&#8364; &copy &am</article>", ["a <b> &amp; é€ © &am"]),
    "white space": ("<article><p> a\n\tb <br>c<p>d<b>e</b>f</article>", ["a b c", "def"]),
    "raw text": ("<article>a<!-- x > y --><script>if(a<b)'</article>'</script><style>p{}</style><textarea>t</textarea>b < c</article>", ["ab < c"]),
    "quotes": ("<article><p title='a > b'>x</p><p title=\"</article>\">y</article>", ["x", "y"]),
    "cut off": ("<article><p>abc<p cla", ["abc"]),
    "comment article": ("<article><p>Body text.</p><article class=comment><p>I like it, much.</p></article></article>", ["Body text."]),
    "links only": ("<article><p>Text here.</p><div><a>One</a> | <a>Twenty two</a></div></article>", ["Text here."]),
    "plain": ("just text < 3 & more", ["just text < 3 & more"]),
    "no text": ("<p></p><nav>menu</nav>", []), "empty": ("", []), "null": (None, []),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_by_hand(name):
    html, want = PAGES[name]
    assert html_text.main_text(html) == "\n\n".join(want)


def test_path_scores_and_smoothing():
    blocks = html_text.blocks_of(f"<p>{LONG}</p><p>{LONG}</p><div>menu</div>")
    scores = html_text.path_scores(blocks)
    assert scores[blocks[0].path] > 10 * scores[blocks[2].path] and blocks[0].path == blocks[1].path
    assert html_text.smoothed([3.0, 3.0, 3.0]) == pytest.approx([3.0, 3.0, 3.0]) and html_text.smoothed([]) == []


def test_odd_pages_in_bulk(spark):
    """Repeated rows, null columns, a very long page, deep nesting, unclosed quotes, clashing columns: a row each."""
    deep, quotes, long = "<div>" * 100_000 + "x" + "</div>" * 100_000, "<a href=\"" * 100_000, "<article>" + "<p>word</p>" * 100_000 + "</article>"
    rows = [(1, "u", deep), (1, "u", deep), (None, None, None), (2, "u", quotes), (3, None, long)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    got = sorted(html_text.extract_pages(df).collect(), key=str)
    assert sorted((str(r.page_id), r.n_chars) for r in got) == sorted([("1", 1), ("1", 1), ("None", 0), ("2", 0), ("3", 100_000 * 6 - 2)])
