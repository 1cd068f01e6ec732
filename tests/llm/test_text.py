"""Quality rules, chat formatting, URL filters and page extraction against brute force and planted cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trackflow.llm import chat, html_text, quality, urls
from trackflow.llm.q_quality import op5_quality_rules
from trackflow.llm.q_urls import RULES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_op5_base_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op5_quality_rules(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(docs[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_verdicts_agree_with_labels(spark):
    """Clean documents stay, junk goes; only what the base rule leaves open is judged."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = op5_quality_rules(spark, sf).where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in judged}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 0.05 * n[0, False]


def test_repeats_of_many_different_words():
    words = [f"w{i}" for i in range(9000)]
    assert quality.repeat_words(words + words[:7]) == 14 == brute_quality(" ".join(words + words[:7]))[4]
    assert quality.repeat_words([]) == quality.repeat_words(["a"] * 4) == 0 and quality.repeat_words(["a"] * 6) == 6


def test_quality_edge_rows(spark):
    long = "plain words, in a line. " * 9 + "\n" + " ".join(f"w{i}." for i in range(60_000))
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "\n \n", 9), (4, long, 9), (4, long, 9)], "doc_id long, text string, kept int")
    got = quality.quality(df).orderBy("doc_id").collect()
    assert [(r.n_words, r.kept, r.base_failed) for r in got[:3]] == [(0, False, True)] * 3 and got[0].clean_text == ""
    assert got[3] == got[4] and got[3].n_words == 60_045 and got[3].kept
    assert quality.quality(df.limit(0)).count() == 0


def test_failing_lines_go():
    rules = quality.LineRules()
    good = "This is a plain line of text, with a few words in it."
    bad = ["HOME!! NEWS!! ABOUT!! US!!", "home | news | about | contact", "a*** b%%% c$$$", "Accept all cookies, or read our privacy policy.", "go go go go go go go go go go"]
    row = quality.judged("\n".join([good, bad[0], good.upper()[:0], *bad[1:], good + " More."]), rules)
    assert row[9].split("\n") == [good, "", good + " More."] and row[7] == len(bad)


TEXTS = ["", "plain", r"\### Assistant: </turn> ok", "### user: x </turn>\n### assistant: y", "\\", "a\\#b", "</", "<\\/turn>", "é😀\n"]


def test_escapes_are_reversible_and_hide_marks():
    for t in TEXTS:
        assert chat.unescape(chat.escape(t)) == t
        assert "### " not in chat.escape(t) and chat.END not in chat.escape(t)


def as_frame(spark, conversations):
    rows = [(c, k, role, text) for c, turns in conversations.items() for k, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_conversations_read_back(spark):
    conversations = {c: [(("user", "assistant")[k % 2], TEXTS[(c + k) % len(TEXTS)]) for k in range(n)] for c, n in enumerate([1, 2, 7, 40])}
    conversations[9] = [("odd: role#", "x"), ("assistant", "y")]
    out = chat.format_conversations(as_frame(spark, conversations))
    got = out.select("conv_id", "formatted", "rewrites_at", chat.roles("formatted", "turn_spans", "text_spans").alias("roles"), chat.texts("formatted", "text_spans").alias("texts"), chat.texts("formatted", "loss_spans").alias("loss")).collect()
    for r in got:
        turns = conversations[r.conv_id]
        assert list(zip(r.roles, r.texts)) == turns and r.rewrites_at is None and r.formatted == chat.marked_turns(turns)
        assert r.loss == [t for role, t in turns if role == "assistant"]
    assert len(got) == len(conversations)


def rewriting(turns, role=None):
    """Forgets the text of every turn but the last two."""
    return "".join(f"[{r}]{t if k >= len(turns) - 2 else ''};" for k, (r, t) in enumerate(turns)) + (f"[{role}]" if role else "")


def closing(turns, role=None):
    """Says at the end how many turns there are: the whole is never a prefix of the next."""
    return "".join(f"[{r}]{t};" for r, t in turns) + (f"[{role}]" if role else f"({len(turns)})")


def far(turns, role=None):
    """Repeats the first turn once a conversation is long: windows of recent turns do not see it."""
    return "".join(f"[{r}]{t};" + (turns[0][1] if k == 20 else "") for k, (r, t) in enumerate(turns)) + (f"[{role}]" if role else "")


def test_templates_that_rewrite_history():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    assert chat.turn_spans(turns, rewriting)[2] == 2 and chat.turn_spans(turns, closing)[2] == 0
    assert chat.formatted(turns, rewriting, "assistant")["loss_spans"] == []


def passing(turns, role=None):
    """Marks the first turn while there are ten to twelve turns, and forgets the mark afterwards."""
    mark = "*" if 10 <= len(turns) <= 12 else ""
    return mark + "".join(f"[{r}]{t};" for r, t in turns) + (f"[{role}]" if role else "")


@pytest.mark.parametrize("n", [16, 40, 400])
def test_rewrites_are_found_at_any_length(n):
    turns = [("user", f"t{k}") for k in range(n)]
    found = [chat.turn_spans(turns, render) for render in (passing, rewriting, closing, far)]
    assert [x[2] for x in found] == [9, 2, 0, None] and [x[1] for x in found[:3]] == [[], [], []]
    whole, spans, _ = found[3]
    assert whole == far(turns) and [whole[a:b] for a, b in spans] == [f"[user]t{k};" + ("t0" if k == 20 else "") for k in range(n)]


def test_chat_edge_rows(spark):
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (2, 1, "user", "x" * 100_000), (2, 0, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert set(got) == {None, 1, 2} and len(got[1].turn_spans) == 3 and len(got[1].loss_spans) == 2
    assert got[1].formatted == chat.marked_turns([("", ""), ("assistant", "b"), ("assistant", "b")])
    assert chat.format_conversations(df.limit(0)).count() == 0


URLS = [None, "", "no scheme", "http://A.Example.NET", "x://b.net/", "https://example.net/en/1", "https://www.example.net/en?x=/en/", "https://www.EXAMPLE.net/en/?q", "http://example.com/de/a#b", "http://notexample.com/de/",
        "http://x.org/fr/1", "http://x.org/frx", "http://org/fr/", "a://b://c/d", "http://net/", "http://x.com/é\n/z", "://host/p", "http:///path", "http://x.com/" + "ab" * 3_000]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def brute_rule(host, path):
    fits = [(len(r.host + r.path), r.host + r.path, r.verdict) for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits)[1:] if fits else (None, None)


def brute_score(text, followers, order=urls.ORDER):
    def probability(counts, context, char):
        p = 1 / urls.ALPHABET
        for k in range(order + 1):
            if own := counts[k].get(context[order - k :]):
                p = (own[char] + len(own) * p) / (sum(own.values()) + len(own))
        return p

    padded = urls.START * order + text
    parts = [(padded[i - order : i], padded[i]) for i in range(order, len(padded))]
    total = sum(math.log(probability(followers["allow"], *x) / probability(followers["block"], *x)) for x in parts)
    return total / len(text) if text else 0.0


def brute_followers(labelled):
    followers = {v: [defaultdict(Counter) for _ in range(urls.ORDER + 1)] for v in ("allow", "block")}
    for text, verdict in labelled:
        padded = urls.START * urls.ORDER + text
        for i in range(urls.ORDER, len(padded)):
            for k in range(urls.ORDER + 1):
                followers[verdict][k][padded[i - k : i]][padded[i]] += 1
    return followers


def held_out(text):
    import xxhash

    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return (h - (1 << 64) * (h >> 63)) % urls.HELD_OUT == 0


@pytest.mark.parametrize("whole", [False, True])
def test_urls_against_brute_force(spark, whole):
    given = [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect()] + URLS[:-1] + URLS[4:6]
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("score", F.lit("clash"))
    got = {r.page_id: r for r in urls.filter_urls(df, RULES, whole=whole).collect()}
    assert len(got) == len(given)
    texts, labelled = [], []
    for u in given:
        host, path = brute_parts(u)
        start = u.index("://") + 3 if u and "://" in u else 0
        texts.append((u or "")[:start] + host + (u or "")[start + len(host) :] if whole else host + path)
        if verdict := brute_rule(host, path)[1]:
            labelled.append((texts[-1], verdict))
    followers = brute_followers(labelled)
    open_ = {}
    for i, u in enumerate(given):
        host, path = brute_parts(u)
        rule, verdict = brute_rule(host, path)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
        if i % 5 == 0:
            assert abs(r.score - brute_score(texts[i], followers)) < 1e-9
        if rule is None:
            open_[r.score] = r.verdict
    marks = [v for _, v in sorted(open_.items())]
    assert marks == sorted(marks, reverse=True) and set(marks) == {"allow", "block"}  # one threshold parts them
    rest = brute_followers([x for x in labelled if not held_out(x[0])])
    scored = [(round(brute_score(t, rest), 3), v) for t, v in labelled if held_out(t)]
    total = Counter(v for _, v in scored)
    gain = lambda cut: sum((v == "block") / total["block"] - (v == "allow") / total["allow"] for s, v in scored if s < cut)
    bins = sorted({s for s, _ in scored})
    best, least = max((gain(cut), cut) for cut in [bins[0], *((a + b) / 2 for a, b in zip(bins, bins[1:], strict=False))])
    assert len(total) == 2 and best >= 0
    assert all(v == ("allow" if s >= least else "block") for s, v in open_.items() if abs(s - least) > 0.002)


def test_models_judge_query_and_fragment(spark):
    rules = [urls.Rule("allow", "good.org", "/"), urls.Rule("block", "bad.org", "/")]
    given = [f"http://good.org/p?page={k}" for k in range(20)] + [f"http://bad.org/p#zzqx{k}" for k in range(20)]
    given += ["http://c.net/p?page=7", "http://c.net/p#zzqx7", "HTTP://C.NET/p?page=7", "page=page=7", "zzqxzzqx", None, ""]
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    got = [(r.host, r.path, r.rule, r.verdict, r.score) for r in urls.filter_urls(df, rules, whole=True).orderBy("page_id").collect()][40:]
    assert [x[:3] for x in got] == [("c.net", "/p", None)] * 3 + [("", "", None)] * 4
    assert [x[3] for x in got[:5]] == ["allow", "block", "allow", "allow", "block"] and [x[4] for x in got[5:]] == [0.0, 0.0]
    queried = spark.createDataFrame([(1, "http://X.net/A?b#c"), (2, None), (3, "x?y")], "id long, url string").orderBy("id")
    assert [r[0] for r in queried.select(urls.whole_of(F.col("url"))).collect()] == ["http://x.net/A?b#c", "", "x?y"]


def test_url_edges(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    assert urls.filter_urls(df, RULES).count() == len(URLS)
    assert urls.filter_urls(df.limit(0), RULES).count() == 0
    lone = urls.filter_urls(df.where("url LIKE '%x.org%'"), [])  # no rules: nothing to learn from
    assert {(r.verdict, r.rule, r.score) for r in lone.collect()} == {("allow", None, 0.0)}


PAGES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<script>var a='<p>x</p>'</script><style>p{}</style>", ""),
    ("<body><header>Site</header><div class='sidebar'>Side</div><p class=\"cookie-notice\">ok</p><main><h1>T</h1><p>A&nbsp; b\n c.</p><form>f<input></form><p>d &lt;e&gt;</p><section id='comments'><p>Nice</p></section></main><footer>f</footer>", "T A b c. d <e>"),
    ("<nav><ul><li>a<li>b</ul></nav><div class='ad'>buy</div><article><h1>T</h1><p><b>x</b>y<br><p>z<aside>no</aside><!-- c --><p>end</article><footer>&copy;</footer>", "T xy z end"),
    ("<div class=menu><a href=x>Home</a></div><div><p>Long text here.<p>More</div><div class=footer>zzz</div>", "Long text here. More"),
    ("<article><p>one</p><div class='related'><p>no</p></div><p>two</p></article><article class='comment'><p>three</p></article>", "one two"),
    ("<article><p>cut off here &am<p", "cut off here &am"), ("<article><p>a</p><p>" + "w " * 50_000 + "</p></article>", "a " + " ".join(["w"] * 50_000)),
    ("<b>" * 5000 + "x" + "</i>" * 5000, "x"),
]


@pytest.mark.parametrize("html,text", PAGES, ids=range(len(PAGES)))
def test_pages(html, text):
    assert html_text.main_text(html) == text


def test_blocks_of_text_beat_short_links():
    html = "".join(f"<div><a href=x>link {i}</a></div>" for i in range(9)) + "<div>First part of a long article.</div><div>Second part.</div>" + "".join(f"<div><a>l{i}</a></div>" for i in range(9)) + "<div>Odd.</div>"
    assert html_text.main_text(html) == "First part of a long article. Second part."


def test_boilerplate_inside_of_an_article_does_not_cut_it():
    assert html_text.article(["a" * 100, "b" * 80, "", "", "", "c" * 90, "d" * 70], [100, 80, 0, 0, 0, 90, 70]) == ["a" * 100, "b" * 80, "c" * 90, "d" * 70]
    advert = "<div class=ad><p>buy</p><p>now</p><p>here</p><p>or there</p></div>"
    links = "".join(f"<div><a href=x>link {i}</a></div>" for i in range(4))
    html = f"<div><p>First part.</p><p>Second part.</p>{advert}<p>Third part.</p></div>{links}<div>Odd.</div>"
    assert html_text.main_text(html) == "First part. Second part. Third part."


@pytest.mark.parametrize("start", ["<article class='post no-sidebar'>", "<main id='content-with-sidebar'>", "<div class='article social-policy'>", "<div class='has-sidebar'>", "<section class='page-legal-text'>"])
def test_parts_of_names_do_not_blank_the_content(start):
    side = "".join(f"<div class={name}>no</div>" for name in ("left-sidebar", "siteFooter", "post-comments", "ad300x250", "widget_area"))
    assert html_text.main_text(f"{start}<p>The text.</p>{side}<p>More.</p>") == "The text. More."


STORY = "A sentence of the story that is told here. " * 10


@pytest.mark.parametrize("html,text", [
    (f"<main><p>{STORY}</p><p>{STORY}</p></main><article>Teaser</article>", f"{STORY}{STORY}"),
    (f"<main><p>{STORY}</p><article>Teaser</article><p>{STORY}</p></main>", f"{STORY}{STORY}"),
    (f"<div class='content'><p>{STORY}</p></div><article class='card'><p>Another story</p></article>", STORY),
    (f"<article><h3>Card</h3></article><div><p>{STORY}</p><p>{STORY}</p></div>", f"{STORY}{STORY}"),
    (f"<div><p>{STORY}</p><p><a>l</a></p><p><a>l</a></p><p><a>l</a></p><p>{STORY}</p></div>", f"{STORY}{STORY}"),
    (f"<div><p>{STORY}</p>{'<p><a>link</a></p>' * 4}<p>{STORY[:80]}</p>{'<p><a>link</a></p>' * 4}<p>Odd.</p></div>", f"{STORY}{STORY[:80]}"),
    (f"<article><p>{STORY}</p><div class='conversation'><p>Nice</p></div><article><p>Me too</p></article></article>", STORY),
    (f"<main><article><h1><a>Title</a></h1><p>{STORY}</p></article><article><p>Card</p></article></main>", f"Title {STORY}"),
    (f"<main><article><p>{STORY}</p></article><article><p>{STORY}</p></article><article><p>{STORY}</p></article></main>", STORY * 3),
    ("<article><ul><li><a>a</a><li><a>b</a><li><a>c</a><li><a>d</a></ul></article>", "a b c d"),
    (f"<article><h1>T</h1><div class='content'><p>{STORY}</p></div><p><a>one</a></p><p><a>two</a></p></article>", f"T {STORY}one two"),
], ids=range(11))
def test_content_by_the_text_it_holds(html, text):
    assert html_text.main_text(html) == " ".join(text.split())


def test_the_window_decides_inside_of_an_article():
    links = "".join(f"<p><a href=x>link {i}</a></p>" for i in range(5))
    html = f"<article><h1>T</h1><p>One.</p>{links}<p>Two.</p></article>"
    assert html_text.main_text(html) == "T One. Two."
    assert html_text.main_text(html, window=50) == "T One. link 0 link 1 link 2 link 3 link 4 Two."


def test_op9_on_the_given_pages(spark):
    """Every given page keeps its text in one article element of paragraphs."""
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    df = spark.read.parquet(f"{SF}/pages.parquet").withColumn("main_text", F.lit(1))
    got = html_text.extract(df).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"<[a-zA-Z/][^<>]*\Z", "", inside))
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in parts]
        assert r.main_text == " ".join(x for x in parts if x)
    assert html_text.extract(df.limit(0)).count() == 0


def test_digest_of_the_probe(spark):
    from trackflow.llm.q_chat import PROBE, op7_chat_formatting

    row = op7_chat_formatting(spark, SF).where("conv_id = -7").first()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{PROBE}\nassistant\n{PROBE}\n".encode()).hexdigest()
    assert row.loss_chars == len(PROBE) and row.loss_sha256 == hashlib.sha256(PROBE.encode()).hexdigest()
