"""URL filters, HTML extraction and chat formatting."""

import hashlib
import random
import re
from html import unescape

import pytest

from surveyspark.llm.chat import Budget, Turn, format_conversations, read_back, read_turns, windows
from surveyspark.llm.html_text import extract_text, main_text
from surveyspark.llm.queries import URL_RULES
from surveyspark.llm.url_filter import UNWANTED, judge_urls, labelled_urls


@pytest.fixture
def judged(spark):
    def run(urls):
        pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(urls)],
                                      "page_id long, url string, host string, rule string")
        rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
        return judge_urls(pages, rules, labelled_urls(spark))
    return run


def by_rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in URL_RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_urls_are_split_and_judged_by_the_longest_rule(judged):
    urls = ["http://WWW.Example.com/en/1?x", "https://a.example.com/en/", "https://example.com/en", "x://com/", "x://com",
            "http://b.NET/es/?/fr/", "http://net/fr/a#b", "http://notnet/fr/", "http://a.net/Es/", None, "", "no scheme",
            "http://?q", "a://b://c/d", "http://h\n.com/p\nq", "https://www.example.com/en/2#/", "http://example.com.evil.org/en/",
            "http://" + "a." * 300 + "net/es/", "http://x.org/" + "long/" * 5000]
    got = {r.page_id: r for r in judged(urls).collect()}
    assert len(got) == len(urls)
    for k, url in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
        path = m[2] if m else ""
        rule, verdict = by_rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict == verdict if rule else got[k].verdict in ("allow", "block")


def test_model_on_hosts_it_has_not_seen(judged):
    bad = [f"https://{w}-zone.test.org/en/{k}" for k, w in enumerate(UNWANTED)] + ["http://best-casino.test.org/a"]
    good = [f"https://{w}.test.org/de/{k}" for k, w in enumerate(
        ("village", "chemistry", "poetry", "harbour", "botany", "cooking", "railway", "opera", "dentist", "bridge"))]
    got = {r.page_id: r.verdict for r in judged(bad + good).collect()}
    assert sum(got[k] == "block" for k in range(len(bad))) >= 0.9 * len(bad)
    assert sum(got[len(bad) + k] == "allow" for k in range(len(good))) >= 0.9 * len(good)


def test_url_filter_is_native_and_takes_no_rows(judged):
    df = judged(["http://a.org/"])
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    assert df.filter("1 = 0").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy, now, this.</div>
<div class="cookie-notice"><p>We use cookies, and more cookies, and even more of them, for all sorts of purposes.</p></div>
%s<aside class="sidebar"><p>Other, things, to, read, elsewhere, on, this, very, site, today.</p></aside>
<section id="comments"><p>%s</p></section><form><p>Sign up</p><input name="a"></form><footer>&copy; site</footer></body></html>"""
LONG = "A sentence, with commas, that goes on for a while, as sentences do, until it ends. "


@pytest.mark.parametrize("body, text", [
    ("<article><h1>Head &amp; line</h1><p><b>Bold.<br><p>One&nbsp;two\n three.</p><p>x</p></article>",
     "Head & line Bold. One two three. x"),
    (f"<article><header><h2>No</h2></header><section><p>{LONG}</p></section><section><p>Short.</p></section></article>",
     LONG.strip() + " Short."),
    (f"<div id=main><p>{LONG * 3}</p><p>Tail.</p></div>", (LONG * 3).strip() + " Tail."),
    (f"<div><div><h2>Part</h2><p>{LONG * 2}</p></div><div><p>{LONG * 2}</p></div></div>",
     "Part " + (LONG * 2).strip() + " " + (LONG * 2).strip()),
    (f"<main><p>{LONG}</p><ul class=menu><li><a href=x>Menu</a></li></ul><ul><li>Point one</li><li>Point two</li></ul></main>",
     LONG.strip() + " Point one Point two"),
    (f"<article><p>a<b>b</b>c &eacute;&#233;</p><table><tr><td>1<td>2</table><pre>x\n  y</pre><p>{LONG}</article>",
     "abc éé 1 2 x y " + LONG.strip()),
    (f"<article><p>{LONG}<div hidden>secret</div><p style='display: none'>no<p>end", LONG.strip() + " end"),
])
def test_main_text(body, text):
    assert main_text(PAGE % (body, LONG * 20)) == text


@pytest.mark.parametrize("page", [
    "<form>%s</form>", "<form id=aspnetForm><div><nav>x</nav>%s</div><input name=a></form>", "<div role=form>%s</div>",
    "<header>%s</header>", "<fieldset><div class=header>%s</div></fieldset>"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_an_article_is_kept_whole_wherever_it_is(page, tag):
    blocks = [f"<p>{LONG}</p>", f'<div class="share-of-income"><p>{LONG}</p></div>',
              f'<section id="social-policy">{LONG}</section>', f'<div class="ad-hoc menuOfTheDay">{LONG}</div>']
    furniture = ('<div class="social-share-buttons">Share</div><div class="relatedPosts">More</div>'
                 '<div class="ad ad-300x250">Buy</div><form>Sign up</form><header>Head</header>')
    text = " ".join([LONG.strip()] * 4)
    assert main_text(page % f"<{tag}>{''.join(blocks)}{furniture}</{tag}>") == text
    assert main_text(PAGE % (page % f"<{tag}>{''.join(blocks)}{furniture}</{tag}>", LONG)) == text


def test_sibling_articles_and_headings():
    two = f"<article><p>{LONG * 3}</p></article><article><p>Short one.</p></article>"
    text = (LONG * 3).strip() + " Short one."
    assert main_text(two) == main_text(f"<main>{two}</main>") == text
    assert main_text(PAGE % (two, LONG)) == text
    assert main_text(f"<div><h1>Title</h1>{two}<h2>Related</h2></div>") == "Title " + text
    comments = f'<article class="comment"><p>{LONG}</p></article>'
    assert main_text(two + comments * 9) == text
    assert main_text(f"<article><p>{LONG}</p><article><p>{LONG * 2}</p></article></article>") == (LONG * 3).strip()


def plain_text(html):
    """The text of pages whose blocks are all h1, p or li of one article, by patterns alone."""
    body = re.search(r"<article>(.*)</article>", html, re.S).group(1)
    blocks = re.split(r"</?(?:h1|p|li|ul)>|<br>", body)
    texts = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
    return " ".join(t for t in texts if t)


def test_pages_against_patterns(spark):
    import duckdb
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet' where html is not null").fetchall()
    simple = [h for h, in rows if h.count("<article>") == h.count("</article>") == 1]
    assert len(simple) > 0.9 * len(rows)
    assert [h for h in simple if main_text(h) != plain_text(h)] == []


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<html><nav>x</nav></html>") == ""
    assert main_text("plain words") == "plain words"
    assert main_text("<p>cut &amp") == "cut &"
    deep = "<div>" * 5000 + "<p>" + LONG + "</p>"
    assert main_text(deep) == LONG.strip()
    assert main_text("<article>" + f"<p>{LONG}</p>" * 3000 + "</article>").count("commas") == 3000


def test_pages_of_a_table(spark):
    rows = [(1, "u", "<article><p>é</p></article>", "t"), (1, "u", "<article><p>é</p></article>", "t"), (2, None, None, None)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert sorted(map(tuple, got.collect())) == [(1, "u", "é", 1), (1, "u", "é", 1), (2, None, "", 0)]
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


PARTS = ["\\", "### ", "</turn>", ": ", "\n", "a b c", " ", "é", "#", "</turn>\n", "assistant", "\\### Assistant: </turn> ok"]


@pytest.mark.parametrize("seed", range(5))
def test_windows_read_back_exactly(seed):
    rnd = random.Random(seed)
    for _ in range(300):
        turns = [(rnd.choice(["system", "user", "assistant", "a: ", "x\\", "### "]),
                  "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9)))) for _ in range(rnd.randint(0, 12))]
        budget = Budget(rnd.randint(1, 60), rnd.randint(0, 25))
        made = list(windows((Turn(*t) for t in turns), budget))
        assert [(r, t) for w in made for r, t, _, _ in read_turns(w.text[w.new_at:])] == turns
        masked = [re.sub(r"\\(\\|### |</turn>)", r"\1", w.text[a:b]) for w in made for a, b in w.spans]
        assert masked == [t for r, t in turns if r == "assistant"]
        for k, w in enumerate(made):
            whole = [(r, t) for r, t, _, _ in read_turns(w.text)]
            if turns[0][0] == "system":
                assert whole[0] == turns[0]
            size = sum(Turn(*t).tokens for t in whole)
            own = len(list(read_turns(w.text[w.new_at:])))
            assert size <= budget.window or own == 1 or (k == 0 and own <= 2)


def test_history_is_repeated_within_its_limit():
    turns = [Turn("user" if k % 2 == 0 else "assistant", f"w{k} " * 10) for k in range(20)]
    made = list(windows(iter(turns), Budget(60, 30)))
    for before, w in zip(made, made[1:]):
        repeated = [t for _, t, _, _ in read_turns(w.text[:w.new_at])]
        assert repeated and sum(Turn("user", t).tokens for t in repeated) <= 30
        assert [t for _, t, _, _ in read_turns(before.text)][-len(repeated):] == repeated


def test_conversations_of_a_table(spark):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant", "system"]), "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 8))), 1)
            for c in range(30) for t in range(rnd.randint(1, 9))]
    rows += [(77, t, "assistant", f"long {t} " * 40, 1) for t in range(300)]            # one long conversation
    rows += [(None, 0, "user", "no id", 1), (40, None, None, None, 1), (40, 0, "assistant", None, 1), (40, 0, "assistant", None, 1)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window long")
    got = {r.conv_id: r for r in read_back(format_conversations(df, Budget(100, 30))).collect()}
    talks = {}
    for c, t, role, text, _ in rows:
        talks.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(talks)
    for c, own in talks.items():
        own.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in own)
        loss = "".join(t for _, r, t in own if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars >= len(said)
    assert read_back(format_conversations(df.limit(0))).count() == 0


@pytest.mark.parametrize("name", ["content has-sidebar", "layout no-sidebar", "post comments-open", "page ad-free"])
def test_wrappers_named_after_what_they_hold_or_lack(name):
    menu = "<ul>" + "<li><a href='/'>Somewhere else on this site</a></li>" * 40 + "</ul>"
    text = f"<p>{LONG}</p><p>{LONG}</p>"
    side = f'<div class="sidebar"><p>{LONG}</p></div>'
    want = f"{LONG.strip()} {LONG.strip()}"
    assert main_text(f'<body><div class="{name}"><article>{text}</article>{side}</div></body>') == want
    assert main_text(f'<body>{menu}<div class="{name}"><main><div class="{name}"><article>{text}</article></div></main></div></body>') == want
    assert main_text(f'<body><div class="{name}"><div>{text}</div></div><div class="ad"><p>{LONG}</p></div></body>') == want


def test_long_comments_are_no_wrapper():
    text, talk = f"<p>{LONG}</p>", f"<p>{LONG}</p>" * 5
    for body in (f"<article>{text}</article>", f"<div>{text}</div>"):
        assert main_text(f'<body>{body}<div class="comments">{talk}</div></body>') == LONG.strip()
    assert main_text(f'<body><article>{text}</article><div class="comments-area">{talk}</div></body>') == LONG.strip()
