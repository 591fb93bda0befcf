"""Sharding, spelling variants and conversation repair against plain Python versions."""

import collections
import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest

from lakemart.llm import common, conversation_repair, queries, shard_ring, spelling
from tests.conftest import SMALL_SF

RND = random.Random(11)


# ---------------------------------------------------------------- sharding

def _md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def _plain_shards(rows, n, vnodes, capacity):
    """One row at a time: the first point clockwise whose shard has room."""
    points = sorted((int(_md5(f"{s}:{v}")[:8], 16), s, v) for s in range(n) for v in range(vnodes))
    places, room, out = [p[0] for p in points], list(capacity), collections.Counter()
    keyed = []
    for key, text in rows:
        h = _md5("" if key is None else str(key))
        place = int(h[:8], 16)
        arc = next((i for i, p in enumerate(places) if p >= place), 0)
        keyed.append((int(h[8:10], 16), arc, place, key is not None, key or 0, zlib.crc32((text or "").encode()), key, text))
    for *_, key, text in sorted(keyed, key=lambda k: k[:6]):
        arc = next(i for i, p in enumerate(places + [1 << 40]) if p >= int(_md5("" if key is None else str(key))[:8], 16)) % len(places)
        s = next(p[1] for p in points[arc:] + points[:arc] if room[p[1]] > 0)
        room[s] -= 1
        out[(key, text, s)] += 1
    return out


SHARD_ROWS = ([(i, f"text {i}") for i in range(400)] + [(7, f"many {i}") for i in range(200)] + [(9, "same")] * 150
              + [(None, None), (None, "é"), (1000, None), (1001, ""), (1002, "long " * 5000)])


@pytest.fixture(scope="module")
def shard_docs(spark):
    rows = [(i, t, "en", 1, 2, 3, 4) for i, t in SHARD_ROWS]
    return spark.createDataFrame(RND.sample(rows, len(rows)),
                                 "doc_id long, text string, lang string, shard int, key int, cell int, row int").repartition(7).cache()


def test_shards_are_those_of_one_row_at_a_time(shard_docs):
    n = len(SHARD_ROWS)
    got = shard_ring.sharded(shard_docs, 5, 8).collect()
    assert collections.Counter(g.shard for g in got) == {s: n // 5 + (s < n % 5) for s in range(5)}
    for s in range(5):
        assert sorted(g.slot for g in got if g.shard == s) == list(range(sum(g.shard == s for g in got)))
    want = _plain_shards(SHARD_ROWS, 5, 8, [n // 5 + (s < n % 5) for s in range(5)])
    sizes = lambda t: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
    assert (collections.Counter((g.doc_id, g.size, g.text_crc32, g.shard) for g in got)
            == collections.Counter({(k, *sizes(t), s): c for (k, t, s), c in want.items()}))
    assert {(g.law, g.grown_shard) for g in got} == {("rows", None)}
    again = shard_ring.sharded(shard_docs.repartition(3), 5, 8).collect()
    key = lambda g: (g.doc_id, g.size, g.text_crc32, g.shard, g.slot)
    assert sorted(map(key, got), key=str) == sorted(map(key, again), key=str)


def test_slack_bounds_loads_and_movement(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "cast(id as string) as text").repartition(4)

    def shards(n, slack):
        return {r.key: r.shard for r in shard_ring.assign(docs, n, 64, slack).collect()}

    moved = {}
    for slack in (0.0, 0.25):
        a, b = shards(12, slack), shards(13, slack)
        assert max(collections.Counter(a.values()).values()) <= -(-6000 * (1 + slack) // 12) and len(a) == 6000
        moved[slack] = sum(a[k] != b[k] for k in a) / 6000
    assert moved[0.25] < 0.25 and moved[0.25] <= moved[0.0] < 0.6   # modulo would move 92 %


def test_more_shards_than_rows_and_no_rows(spark):
    few = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert sorted(r.slot for r in shard_ring.sharded(few, 24, 4).collect()) == [0, 0]
    assert shard_ring.sharded(few.limit(0), 24, 4).count() == 0


# ---------------------------------------------------------------- spelling

def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = len(os.path.commonprefix([a, b]))
    if len(a) == len(b):
        return a[p + 1:] == b[p + 1:]
    a, b = sorted((a, b), key=len)
    return a[p:] == b[p + 1:]


def _plain_variants(vocab, ratio):
    out = {}
    for w, n in vocab.items():
        near = [x for x in vocab if _near(w, x)]
        form = min(near, key=lambda x: (-vocab[x], x), default=None)
        form = form if form is not None and vocab[form] >= ratio * n else None
        out[w] = [n, form, vocab.get(form), len(near), None]
    for w in out:
        top = w
        while out[top][1] is not None:
            top = out[top][1]
        out[w][4] = top
    return {w: tuple(v) for w, v in out.items()}


@pytest.mark.parametrize("limit", [2, 40, spelling.LIMIT])   # 2: holes are cut down to one letter
def test_variants_by_brute_force(spark, limit):
    rnd = random.Random(limit)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 6))) for _ in range(250)}
    words |= {"x" * 300, "x" * 299, "x" * 150 + "y" + "x" * 149, "日本語", "日本"}
    vocab = {w: rnd.choice([1, 2, 5, 30, 400, 6000, 90000]) for w in words}
    df = spark.createDataFrame([(w, n, 1) for w, n in vocab.items()], "word string, n long, form int").repartition(5)
    got = {r.word: (r.n, r.form, r.form_n, r.n_near, r.root) for r in spelling.group_variants(df, 10, limit).collect()}
    assert got == _plain_variants(vocab, 10)


def test_pairs_have_no_double(spark):
    words = sorted({"".join(p) for k in (2, 3, 4) for p in itertools.product("ab", repeat=k)})
    rows = sorted((hash((m, s, e, w[:s], w[len(w) - max(0, m - e):] if m > e else "")), w, m, s, e)
                  for w in words for m in (len(w), len(w) - 1) for s, e in ((0, m // 2), (m // 2, m + 1)) if m and s < e)
    a, b = spelling.near_pairs([r[1] for r in rows], *[np.array([r[k] for r in rows], np.int64) for k in (0, 2, 3, 4)])
    got = [tuple(sorted((rows[i][1], rows[j][1]))) for i, j in zip(a, b)]
    want = {(x, y) for x in words for y in words if x < y and _near(x, y)}
    assert set(got) == want
    assert all(got.count(p) == (2 if len(p[0]) == len(p[1]) else 1) for p in want)


def _plain_vocabulary(rows, length, least, slip):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if slip and h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= length:
                n[w] += 1
    return {w: k for w, k in n.items() if k >= least}


def test_vocabulary(spark):
    rnd = random.Random(4)
    base = ["Étéhabit", "mañanera", "Straßenrand", "abcdefgh", "ABCDEFGH", "aªbcdefghij", "x×y÷zabcdef", "日本語abcdefg", "kurz"]
    rows = [(i, " ".join(rnd.choice(base) + rnd.choice(["", ",", "1", "é"]) for _ in range(rnd.randint(0, 60)))) for i in range(60)]
    rows += [(None, "abcdefgh abcdefgh"), (5, None), (6, ""), rows[3], rows[3], (7, "abcdefgh " * 300000), (8, "q" * 2000000), (9, "q" * 2000000)]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    for slip in (0, 3):
        got = {r.word: r.n for r in spelling.vocabulary(df, 7, 2, slip).collect()}
        assert got == _plain_vocabulary(rows, 7, 2, slip)
    assert spelling.group_variants(spelling.vocabulary(df.limit(0))).count() == 0


def test_registered_spelling_by_plain_python(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").collect()]
    vocab = _plain_vocabulary(rows, 7, 2, 31)
    got = {r.word: r for r in queries.QUERIES["op12_spelling"](spark, SMALL_SF).collect()}
    assert {w: r.n for w, r in got.items()} == vocab
    some = random.Random(2).sample(sorted(vocab), 60)
    for w in some:
        near = [x for x in vocab if _near(w, x)]
        assert got[w].n_near == len(near)
        best = min(near, key=lambda x: (-vocab[x], x), default=None)
        assert got[w].form == (best if best is not None and vocab[best] >= 10 * vocab[w] else None)


# ---------------------------------------------------------------- conversations

def _plain_repair(rows):
    """All edit sequences of a short conversation, cheapest first. rows: (role, text, must_go, truncated)."""
    best = {(): (0, "", ())}   # role initials that matter: the last one and whether anything is there
    def offer(to, key, cand):
        if key not in to or cand[:2] < to[key][:2]:
            to[key] = cand
    def ok(seq, x):
        return x in {"": "su", "s": "u", "u": "a", "a": "u"}[seq]
    now = {"": (0, "", ())}
    def inserts(now):
        for _ in range(3):
            for seq, (c, x, out) in list(now.items()):
                for i, role in (("u", "user"), ("a", "assistant")):
                    if ok(seq, i):
                        offer(now, i, (c + 5, x + "I", (*out, f"{role}:")))
        return now
    for role, text, must_go, truncated in rows:
        now, to = inserts(dict(now)), {}
        more = 5 if truncated else 0
        for seq, (c, x, out) in now.items():
            offer(to, seq, (c + 2, x + "D", out))
            if must_go:
                continue
            if role[:1] in ("s", "u", "a") and ok(seq, role[0]):
                offer(to, role[0], (c + more, x + "K", (*out, f"{role}:{text}")))
            for i, new in (("u", "user"), ("a", "assistant")):
                if ok(seq, i):
                    offer(to, i, (c + 1 + more, x + "R", (*out, f"{new}:{text}")))
        now = to
    now = inserts(dict(now))
    c, x, out = min(now[s] for s in ("", "a") if s in now)
    return c, x, hashlib.sha256("\n".join(out).encode()).hexdigest()


def _plain_faults(rows):
    """(turn, role, text) rows of a conversation in order -> counts, and rows with their faults."""
    seen, out, n = set(), [], collections.Counter()
    for turn, role, text in rows:
        ink = re.sub(r"[\x20\x09-\x0D]", "", text)
        blank, again, cut = not ink, (role, text) in seen, bool(ink) and ink[-1] not in ".!?"
        seen.add((role, text))
        again, cut = again and not blank, cut and not blank and not again
        n["blank"] += blank
        n["duplicate"] += again
        n["truncated"] += cut
        out.append((role, text, blank or again, cut))
    n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    n["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return n, out


def _plain_damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


TEXTS = ["a.", "b!", "c?", "d", "", "  \n", "e .\t", "日本。", "f.", "g. "]


def _conversations():
    rnd, rows = random.Random(9), []
    for conv in range(250):
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, rnd.choice([turn, turn, turn, None, turn * 2]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]),
                         rnd.choice(TEXTS + [None])))
    rows += [(None, 1, "user", "x."), (None, None, "assistant", "y."), (900, 1, "user", "long. " * 20000), (900, 2, "assistant", "z.")]
    return rows + rows[5:9] + rows[5:9]


def test_repair_by_plain_python(spark):
    rows = _conversations()
    df = spark.createDataFrame([(*r, 1, "z") for r in RND.sample(rows, len(rows))],
                               "conv_id long, turn long, role string, text string, audit int, there string").repartition(6)
    got = {r.conv_id: r for r in conversation_repair.repair(conversation_repair.damage(df)).collect()}
    want = _plain_damage(rows)
    assert set(got) == set(want)
    for conv, kept in want.items():
        kept = sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        n, faults = _plain_faults(kept)
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == tuple(n[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal"))
        assert (r.cost, r.audit, r.repaired_sha256) == _plain_repair(faults)
        assert all(c in "KRDI" for c in r.audit)
    gone = [c for c, k in want.items() if not k]
    assert gone and all((got[c].cost, got[c].audit, got[c].repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
    assert conversation_repair.repair(conversation_repair.damage(df.limit(0))).count() == 0


def _steps(rows):
    r = conversation_repair.Repair()
    for row in rows:
        r.row(*row)
    return r.end()


def test_settled_letters_and_collisions_change_nothing(monkeypatch):
    rnd = random.Random(3)
    rows = [[(rnd.choice(["user", "assistant", "system", "x"]), f"t{rnd.random()}", rnd.random() < 0.2, rnd.random() < 0.3)
             for _ in range(rnd.randint(0, 60))] for _ in range(150)]
    want = [_plain_repair(r) for r in rows]
    assert [_steps(r) for r in rows] == want
    monkeypatch.setattr(conversation_repair, "NODES", 3)      # settles at every row
    assert [_steps(r) for r in rows] == want
    monkeypatch.setattr(conversation_repair, "_MOD", 7)       # nearly every hash collides
    assert [_steps(r) for r in rows] == want


def test_long_conversation_is_not_held():
    rnd, r, most = random.Random(8), conversation_repair.Repair(), 0
    for k in range(60000):
        r.row("user" if (k + (rnd.random() < 0.1)) % 2 == 0 else "assistant", f"text {k}", rnd.random() < 0.1, rnd.random() < 0.2)
        most = max(most, len(r.rows))
    cost, audit, _ = r.end()
    assert len(audit.replace("I", "")) == 60000 and cost > 0 and most < 3 * conversation_repair.NODES


def test_common_prefix_of_linked_strings():
    rnd, tree = random.Random(6), conversation_repair.Audits()
    strings = ["".join(rnd.choice("DIKR") for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    strings += [s[:rnd.randint(0, len(s))] + rnd.choice(["", "D", "KR"]) for s in strings]
    nodes = []
    for s in strings:
        node = 0
        for c in s:
            node = tree.add(node, c)
        nodes.append(node)
    for a, b in itertools.product(range(len(strings)), repeat=2):
        assert tree.text(tree.common(nodes[a], nodes[b])[0]) == os.path.commonprefix([strings[a], strings[b]])
        assert tree.less(nodes[a], nodes[b]) == (strings[a] < strings[b])


# ---------------------------------------------------------------- columns that clash with the URL filter's own

def test_url_filter_keeps_captures_with_clashing_names(spark):
    from lakemart.llm import url_filter

    captures = spark.createDataFrame([(1, "http://a.b.com/x", "2024-01-05", "h", 7, "l", "k", "w", "o", "d", 3, "z")],
                                     "page_id int, url string, day string, url_host string, n int, lists string, block string, allow string, "
                                     "`on` string, domain string, n_active int, url_host_ string").selectExpr("* except (day)", "date(day) as day")
    entries = spark.createDataFrame([("s", "block", "b.com", "2024-01-01", "add", 1)],
                                    "list string, verdict string, domain string, day string, action string, n int").selectExpr("* except (day)", "date(day) as day")
    got = url_filter.judge(captures, entries).collect()
    assert len(got) == 1
    r = got[0].asDict()
    assert (r["url_host"], r["n_active"], r["active_lists"], r["blocked"]) == ("a.b.com", 1, "s", True)
    assert (r["url_host__"], r["url_host_"], r["n_active_"], r["n"], r["lists"], r["block"], r["allow"], r["on"], r["domain"]) == (
        "h", "z", 3, 7, "l", "k", "w", "o", "d")


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """A driver that has the repository on its own path only, from another folder."""
    import subprocess
    import sys
    import textwrap

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {repo!r})
        from lakemart.session import build_session
        spark = build_session("local[2]", shuffle_partitions=2)
        from lakemart.llm import decontaminate, jaccard_join, perplexity, quality_rules, spelling, substring_dedup
        docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g h")], "doc_id long, text string")
        assert jaccard_join.near_duplicates(docs).where("component_id = 1").count() == 2
        assert spelling.vocabulary(docs, 1).count() == 8
        items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
        assert decontaminate.contamination(docs, items).where("n_hit = 3").count() == 2
        assert substring_dedup.dedup(docs).count() == 2
        more = spark.range(40).selectExpr("id as doc_id", "concat('word ', id, ' other words') as text", "'en' as lang")
        labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic")
        assert perplexity.classify(more, labels).count() == 40
        assert quality_rules.score(more, quality_rules.fit(more, labels, rounds=3)).count() == 40
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=300, capture_output=True)


# ---------------------------------------------------------------- pages whose article is known

def _article(rnd):
    """(html, text) of an article: paragraphs first and last, anything between."""
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9)))
    say = lambda a, z: ", ".join(" ".join(word() for _ in range(rnd.randint(3, 7))) for _ in range(rnd.randint(a, z))) + "."
    out, text = [], []
    n = rnd.randint(3, 8)
    for i in range(n):
        t = say(2, 6)
        kind = rnd.choice(["p", "p", "p", "h2", "blockquote", "ul", "div", "pre", "figure"]) if 0 < i < n - 1 else "p"
        if kind == "ul":
            items = [say(1, 1) for _ in range(rnd.randint(1, 4))]
            out.append("<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>")
            text += items
        elif kind == "div":
            t = say(1, 1)
            out.append(f"<div>{t}</div>")
            text.append(t)
        elif kind == "h2":
            t = say(1, 1)
            out.append(f"<h2>{t}</h2><p>{(u := say(2, 4))}</p>")
            text += [t, u]
        elif kind == "figure":
            out.append(f"<figure><img src=x><figcaption>{t}</figcaption></figure>")
            text.append(t)
        else:
            out.append(f"<{kind}>{t}</{kind}>" if rnd.random() < 0.7 or kind != "p" else f"<p>{t}")
            text.append(t)
    return "\n".join(out), "\n\n".join(text)


BEFORE = ["<nav><a href=/>Home</a> <a href=/x>News, sport, and, more</a></nav>", "<header><h1>Site name</h1><p>Our motto, which is long, and wise.</p></header>",
          "<script>var a = '<p>not, text, at, all, but, long, long</p>';</script>", "<style>p { color: red, blue, green }</style>",
          "<form action=/search><input name=q><label>Search, find, look for something on the site</label><button>Go</button></form>",
          "<div style='display:none'><p>Hidden, words, with, many, commas, so, many, that, it, wins, over, all, else.</p></div>",
          "<div hidden><p>More, hidden, words, with, commas, and, so, on, and, on, and, on, and, on.</p></div>", "<div class='cookie-notice'>We use cookies, as everybody does, accept them.</div>"]
AFTER = ["<footer><p>Rights, all of them, reserved, by us, since long ago.</p></footer>", "<aside><p>Something else, beside, the, point, entirely, and, long.</p></aside>",
         "<div class=comments><div><p>A comment, long, with commas, and more, and more.</p></div><div><p>Another one, of the same, length, and commas.</p></div></div>",
         "<ul class=related><li><a href=1>One more article</a><li><a href=2>And another</a></ul>", "<form><p>Subscribe, now, to our letter, it is free, and weekly.</p><input></form>",
         "<div class='ad'>Buy, buy, buy, and buy some more, dear reader.</div>"]
FRAMES = ["%s", "<div>%s</div>", "<form id=aspnetForm>%s</form>", "<div class='page'><div class='inner'>%s</div></div>", "<form><div id=wrap>%s</div></form>"]
HOLDERS = ["<div>%s</div>", "<article>%s</article>", "<main><div class=content>%s</div></main>", "<section><div>%s</div></section>", "<div class='content has-sidebar'>%s</div>"]


@pytest.mark.parametrize("seed", range(120))
def test_generated_pages_give_their_article(seed):
    from lakemart.llm import html_text

    rnd = random.Random(seed)
    source, text = _article(rnd)
    junk = lambda all_: "".join(rnd.sample(all_, rnd.randint(0, len(all_))))
    page = rnd.choice(FRAMES) % (junk(BEFORE) + rnd.choice(HOLDERS) % source + junk(AFTER))
    assert html_text.main_text(f"<html><head><title>T, t, t</title></head><body>{page}</body></html>") == text


@pytest.mark.parametrize("between", ["<blockquote>A quotation, from somebody.</blockquote>", "<div>Short.</div>", "<div><i>A note</i></div>", "<figure><figcaption>What is seen</figcaption></figure>"])
def test_what_stands_between_kept_siblings_is_kept(between):
    from lakemart.llm import html_text

    long = "Some long text, with commas, that goes on for a while, and then on, and on, until it ends."
    page = f"<body><p>{long}</p><p>{long}</p><div><p>{long}</p><p>{long}</p></div>{between}<p>{long}</p></body>"
    got = html_text.main_text(page)
    assert re.sub("<[^>]*>", "", between) in got.split("\n\n") and got.count(long) >= 3


@pytest.mark.parametrize("page", ["<form><p>Please enter your name, and your password.</p><input></form>", "<form><label>Name, first and last, as in your passport</label></form>"])
def test_a_form_alone_is_no_text(page):
    from lakemart.llm import html_text

    assert html_text.main_text(f"<body>{page}</body>") == ""
