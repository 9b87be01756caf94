import hashlib
import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import chat_format, queries, url_filter

PIECES = st.lists(st.sampled_from([*chat_format.CONTROL, "\\", "\\n", "\n", "<", "[", "s>", "a", "é"]), max_size=8).map("".join)
TURNS = st.lists(st.tuples(PIECES, PIECES), max_size=24)


@settings(max_examples=200, deadline=None)
@given(PIECES)
def test_escapes_are_reversible(text):
    out = chat_format.escape(text)
    assert chat_format.unescape(out) == text
    assert not any(c in out for c in chat_format.CONTROL)


@settings(max_examples=100, deadline=None)
@given(TURNS)
def test_spans_and_parse(turns):
    text, spans = chat_format.locate(chat_format.render, turns)
    assert chat_format.parse(text) == turns
    assert [text[a:b] for a, b, _, _ in spans] == [chat_format.render([t]) for t in turns]
    assert [chat_format.unescape(text[c:d]) for _, _, c, d in spans] == [t for _, t in turns]


def joined(one):
    return lambda turns: "".join(one(k, len(turns), r, t) for k, (r, t) in enumerate(turns))


def rewriting(changes):
    """The first turn is dropped where ``changes`` says so of the number of turns."""
    return lambda turns: "".join(f"{r}:{t};" for r, t in (turns[1:] if turns and changes(len(turns)) else turns))


TEMPLATES = {  # name: template, and whether it rewrites at one of 0 to n turns
    "numbered": (joined(lambda k, n, r, t: f"{k}{r}:{t};"), lambda n: False),
    "plain": (joined(lambda k, n, r, t: f"<{r}>{t}</{r}>"), lambda n: False),
    "counted": (joined(lambda k, n, r, t: f"[{len(t)}]{t};"), lambda n: False),
    "once at 18": (rewriting(lambda n: n == 18), lambda n: n >= 18),
    "multiples of 20": (rewriting(lambda n: n % 20 == 0), lambda n: n >= 20),
    "last only": (joined(lambda k, n, r, t: f"{r}:{t if k == n - 1 else t[:1]};"), lambda n: n > 1),
    "after a user": (lambda turns: f"{len(turns)};" if len(turns) > 40 and turns[-1][0] == "user" else
                     "".join(f"{r}:{t};" for r, t in turns), lambda n: n > 40),
}


@settings(max_examples=80, deadline=None)
@given(st.sampled_from(sorted(TEMPLATES)), st.integers(0, 150))
def test_any_template_at_any_length(name, n):
    template, rewrites = TEMPLATES[name]
    turns = [("user" if k % 2 == 0 else "assistant", f"text {k}") for k in range(n)]
    text, spans = chat_format.locate(template, turns)
    prefixes = [template(turns[:k]) for k in range(n + 1)]
    kept = all(b.startswith(a) for a, b in zip(prefixes, prefixes[1:], strict=False))
    assert kept != rewrites(n) and text == prefixes[-1]
    assert (spans is not None) == kept
    for k, (start, stop, a, b) in enumerate(spans or []):
        assert (start, stop) == (len(prefixes[k]), len(prefixes[k + 1]))
        assert text[a:b] == turns[k][1]


def test_places_of_texts():
    turns = [("u", "same"), ("\ue000", "same"), ("u", "\ue000 \ue001"), ("u", "")]
    said = lambda template: [text[a:b] if a is not None else None for text, spans in [chat_format.locate(template, turns)]
                             for _, _, a, b in spans]
    assert said(joined(lambda k, n, r, t: f"{t}|{r}")) == [t for _, t in turns]
    assert said(joined(lambda k, n, r, t: f"{t.upper()}|")) == ["SAME", "SAME", "\ue000 \ue001", ""]
    assert said(joined(lambda k, n, r, t: f"{t}={t};")) == [None] * 4  # which of the two is not told
    assert said(joined(lambda k, n, r, t: f"{len(t)}:{t};")) == ["same", "same", "\ue000 \ue001", None]
    assert said(joined(lambda k, n, r, t: "x")) == [None] * 4


def test_local_templates():
    turns = [("user", f"text {k}") for k in range(30)]
    plain, numbered = TEMPLATES["plain"][0], TEMPLATES["numbered"][0]
    for template in (plain, numbered, chat_format.render):  # numbered is not local, whatever its caller says
        assert chat_format.locate(template, turns, local=True) == chat_format.locate(template, turns)
    assert chat_format.locate(TEMPLATES["last only"][0], turns, local=True)[1] is None


def test_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(2, 1, "assistant", "b"), (2, 0, "user", "a"), (1, 0, "user", None), (1, 1, "assistant", said), (1, 2, None, "x"),
            (None, 0, "assistant", "lone"), (3, None, "assistant", ""), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"),
            (5, 0, "assistant", "y" * 300_000)]
    rows += [(6, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(100)]
    frame = spark.createDataFrame([(*r, "more") for r in rows], "conv_id long, turn long, role string, text string, spans string")
    found = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(frame)).collect()}
    by = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] or -1, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    assert set(found) == set(by)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = found[c]
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha(loss))
        assert row["formatted_chars"] == len(chat_format.render(turns))
    assert chat_format.format_conversations(frame.limit(0)).count() == 0


def test_rewriting_template_in_spark(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    counted = lambda turns: f"{len(turns)} turns"
    row = chat_format.format_conversations(frame, counted).first()
    assert row["rewrites_history"] and row["spans"] is None and row["formatted"] == "2 turns"


# -- URLs ------------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain_rule(host, path, rules):
    fits = []
    for rule in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/EN/x", "https://www.example.com/en/7?x#y", "http://com/en/",
        "x://example.net?q=/de/8", "x://a.example.net/de/8#z", "x://net/de/", "ftp://b.org/es/1", "http://É.org/es/", "a://b://c/d",
        "http://notexample.com/en/7", "http://h\nh.net/de/\n1", "http://x.com/en", "http://x.com//en/", "http://x.org/es/" + "a/" * 4000]


def test_rules_equal_a_plain_version(spark):
    pages = spark.createDataFrame([(k, u, "r") for k, u in enumerate([*URLS, URLS[4]])], "page_id long, url string, RULE string")
    found = url_filter.judge_urls(pages, queries.URL_RULES)
    assert [c for c in found.columns if c.lower() == "rule"] == ["rule"]
    rows = {r["page_id"]: r for r in found.collect()}
    assert len(rows) == len(URLS) + 1
    for k, url in enumerate(URLS):
        host, path = plain_parts(url)
        rule = plain_rule(host, path, queries.URL_RULES)
        assert (rows[k]["host"], rows[k]["path"], rows[k]["rule"]) == (host, path, rule)
        assert rows[k]["verdict"] == queries.URL_RULES.get(rule, "allow")
    assert url_filter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_query_has_the_verdicts_of_the_contract(spark, tmp_path):
    # Written out here: the other tests take their words from URL_RULES itself.
    want = {
        "http://com/en/1": ("com/en/", "block"),
        "http://www.example.com/en/6": ("com/en/", "block"),
        "http://WWW.Example.com/en/71": ("example.com/en/7", "allow"),
        "http://net/de/1": ("net/de/", "allow"),
        "http://www.example.net/de/7": ("net/de/", "allow"),
        "http://www.example.net/de/81": ("example.net/de/8", "block"),
        "http://other.net/de/8": ("net/de/", "allow"),
        "http://example.org/es/1": ("org/es/", "block"),
        "http://example.org/de/1": (None, "allow"),
    }
    pages = spark.createDataFrame([(k, u, "") for k, u in enumerate(want)], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in queries.op1_url_filter(spark, str(tmp_path)).collect()}
    assert found == dict(enumerate(want.values()))


def test_tree(spark):
    urls = []
    urls += [f"http://shop.com/{lang}/item-{k}.html" for lang in ("aa", "bb") for k in range(40)]  # alike, both unlabelled
    urls += [f"http://shop.com/spam/item-{k}.html" for k in range(40)]  # alike in form, blocked by rule
    urls += [f"http://blog.com/x{w}x/page" for w in "abcdefghijklmnop"]  # variable first segment
    urls += ["http://blog.com/xax/bad" for _ in range(12)]
    urls += ["http://few.com/a/1", "http://few.com/b/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = {"shop.com/spam/": "block", "blog.com/xbx/": "block"}
    rows = url_filter.judge_urls(pages, rules).collect()
    of = lambda start: {(r["template"], r["verdict"]) for r in rows if f"http://{r['host']}{r['path']}".startswith(start)}
    heavy = {t for t, _ in of("http://shop.com/aa/") | of("http://shop.com/bb/")}
    assert len(heavy) == 1 and heavy.pop().startswith("/{")
    assert of("http://shop.com/aa/") == of("http://shop.com/bb/") and {v for _, v in of("http://shop.com/aa/")} == {"allow"}
    assert {v for _, v in of("http://shop.com/spam/")} == {"block"}
    assert {t for t, _ in of("http://blog.com/")} == {"/*/{page}"}
    assert {v for _, v in of("http://few.com/")} == {"allow"}


def test_pure_template_rejects_unlabelled(spark):
    # Rules name most children of a variable node; the node's template is pure.
    urls = [f"http://bad.com/p{w}q/in" for w in "abcdefghijklmnopqrst"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = {f"bad.com/p{w}q/": "block" for w in "abcdefghijklmnopqr"}
    rows = {r["path"]: r for r in url_filter.judge_urls(pages, rules).collect()}
    assert rows["/psq/in"]["rule"] is None and rows["/psq/in"]["verdict"] == "block"
    assert rows["/psq/in"]["purity"] == 19 / 20


def test_deep_branches_are_judged_apart(spark):
    urls = [f"http://shop.com/cat/item/spam/{k}" for k in range(20)] + [f"http://shop.com/cat/item/good/{k}" for k in range(50)]
    urls += [f"http://deep.com/{'a/' * 30}{w}/{k}" for w in ("spam", "good") for k in range(20)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = {"shop.com/cat/item/spam/": "block", f"deep.com/{'a/' * 30}spam/": "block"}
    rows = url_filter.judge_urls(pages, rules).collect()
    for r in rows:
        assert r["verdict"] == ("block" if "/spam/" in r["path"] else "allow")
    assert {r["template"] for r in rows if r["host"] == "shop.com"} == {"/cat/item/spam/0", "/cat/item/good/0"}


def test_branches_alike_merge_beside_a_heavier_other(spark):
    # The heaviest blocked branch has another form; the two light ones are alike.
    urls = [f"http://site.com/heavy/{'xyz'[k % 3]}" for k in range(60)]
    urls += [f"http://site.com/{b}/{k}" for b in ("one", "two") for k in range(10)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = {"site.com/heavy/": "block"} | {f"site.com/{b}/{k}": "block" for b in ("one", "two") for k in range(6)}
    rows = url_filter.judge_urls(pages, rules).collect()
    assert {(r["template"], r["purity"]) for r in rows if "/heavy/" not in r["path"]} == {("/{two}/0", 13 / 14)}
    assert {r["verdict"] for r in rows} == {"block"}


def plain_verdicts(urls, rules):
    """The whole tree of every host, in plain Python over all URLs."""
    parts = [plain_parts(u) for u in urls]
    named = [plain_rule(h, p, rules) for h, p in parts]
    raws = [re.sub("[0-9]+", "0", p) for _, p in parts]
    bound = lambda n: math.sqrt(0.5 * math.log(2 / 0.05)) / math.sqrt(n)
    template = {}

    def grow(rows, done):
        """``rows``: (index, rest of the segments) of one node."""
        lead = 0
        while len({tuple(rest[lead : lead + 1]) for _, rest in rows}) == 1 and rows[0][1][lead : lead + 1]:
            lead += 1
        done += "".join(rows[0][1][:lead])
        rows = [(i, rest[lead:]) for i, rest in rows]
        if all(not rest for _, rest in rows):
            for i, _ in rows:
                template[i] = done
            return
        first = lambda rest: rest[0] if rest else ""
        kids = Counter(first(rest) for _, rest in rows)
        if len(kids) >= 8 and len(kids) >= 0.3 * len(rows):
            rows = [(i, ["/*", *rest[1:]] if rest else rest) for i, rest in rows]
        groups = {}
        for i, rest in rows:
            groups.setdefault(first(rest), []).append((i, rest))
        about = {}
        for s, own in groups.items():
            if s and len(own) >= 10:
                kinds = Counter(rest[1] if len(rest) > 1 else "" for _, rest in own)
                about[s] = (len(own), kinds, *(sum(rules.get(named[i]) == v for i, _ in own) for v in ("block", "allow")))
        heads, to = [], {}
        for s in sorted(about, key=lambda s: (about[s][0], s), reverse=True):
            n, kinds, *labels = about[s]
            for h in heads:
                hn, hkinds, *hlabels = about[h]
                own_missing = sum(hkinds[k] for k in hkinds if k not in kinds) / hn
                gaps = [abs(kinds[k] / n - hkinds[k] / hn) for k in kinds] + [own_missing]
                gaps += [abs(a / n - b / hn) for a, b in zip(labels, hlabels, strict=True)]
                if max(gaps) < bound(n) + bound(hn):
                    to[s] = to[h] = h
                    break
            else:
                heads.append(s)
        merged = {}
        for s, own in groups.items():
            merged.setdefault(f"/{{{to[s][1:]}}}" if s in to else s, []).extend(own)
        for s, own in merged.items():
            grow([(i, rest[1:]) for i, rest in own], done + s)

    hosts = {}
    for i, (host, _) in enumerate(parts):
        if host:
            hosts.setdefault(host, []).append((i, ["/" + x for x in raws[i].split("/")[1:]]))
    for rows in hosts.values():
        grow(rows, "")
    counts = Counter((parts[i][0], template[i], rules.get(named[i])) for i in template)
    out = []
    for i, (host, path) in enumerate(parts):
        blocked, allowed = (counts[host, template.get(i), v] for v in ("block", "allow"))
        pure = i in template and (blocked + 1) / (blocked + allowed + 2) >= url_filter.PURITY
        out.append((host, path, named[i], rules.get(named[i], "block" if pure else "allow"), template.get(i)))
    return out


def test_query_equals_a_plain_tree(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()
    rows = {r["page_id"]: r for r in queries.op1_url_filter(spark, "/root/testdata/sf0.01").collect()}
    want = plain_verdicts([r["url"] for r in pages], queries.URL_RULES)
    assert len(rows) == len(pages)
    for page, (host, path, rule, verdict, template) in zip(pages, want, strict=True):
        got = rows[page["page_id"]]
        assert (got["host"], got["path"], got["rule"], got["verdict"], got["template"]) == (host, path, rule, verdict, template)


def test_random_trees_equal_a_plain_version(spark):
    rng = random.Random(11)
    urls = []
    for host in ("one.com", "two.com", "three.org"):
        depth = rng.randint(2, 6)
        for _ in range(400):
            urls.append(f"http://{host}/" + "/".join(rng.choice(["a", "b", "spam", "x%d" % rng.randint(0, 40), "item-%d" % rng.randint(0, 9)])
                                                       for _ in range(rng.randint(0, depth))))
    rules = {"one.com/spam/": "block", "two.com/a/": "allow", "two.com/b/spam": "block", "three.org/x": "block"}
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {r["page_id"]: r for r in url_filter.judge_urls(frame, rules).collect()}
    for k, (_, _, rule, verdict, template) in enumerate(plain_verdicts(urls, rules)):
        assert (rows[k]["rule"], rows[k]["verdict"], rows[k]["template"]) == (rule, verdict, template), urls[k]


def test_heads_equal_a_plain_version():
    rng = random.Random(5)
    for _ in range(200):
        full = {}
        for b in range(rng.randint(2, 9)):
            kinds = Counter(rng.choices(range(5), weights=[rng.choice([0, 1, 5]) + 0.01 for _ in range(5)], k=rng.choice([10, 30, 200])))
            blocked = rng.choice([0, 0, sum(kinds.values()) // 2, sum(kinds.values())])
            full[f"/{b}"] = (kinds, sum(kinds.values()), blocked)
        heads, plain = [], {}
        for s in sorted(full, key=lambda s: (full[s][1], s), reverse=True):
            kinds, n, blocked = full[s]
            for h in heads:
                hk, hn, hb = full[h]
                bound = math.sqrt(0.5 * math.log(2 / 0.05)) * (1 / math.sqrt(n) + 1 / math.sqrt(hn))
                missing = sum(hk[k] for k in hk if k not in kinds) / hn
                if max(missing, abs(blocked / n - hb / hn), *(abs(kinds[k] / n - hk[k] / hn) for k in kinds)) < bound:
                    plain[s] = plain[h] = h
                    break
            else:
                heads.append(s)
        having = Counter(k for kinds, _, _ in full.values() for k in kinds)
        branches = {
            s: {"n": n, "blocked": b, "allowed": 0, "alone": max([v / n for k, v in kinds.items() if having[k] == 1], default=0),
                "kinds": {k: v for k, v in kinds.items() if having[k] > 1}}
            for s, (kinds, n, b) in full.items()}
        assert url_filter._alike(branches) == plain
