"""URL rules, WARC, token files, extraction, mixing and chat repair against brute force."""

import base64
import gzip
import hashlib
import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
from fixtures import WORD, corpus, documents, empty, rows_of

from etalage.llm import chat_format, html_extract, mixing, token_files, url_filter, warc
from etalage.llm.queries import URL_RULES, word_bpe
from etalage.llm.storage import fresh_path

URLS = [
    "http://a.Example.org/es/x?y", "https://example.org/en/123#t", "http://example.org/en/2", "ftp://x.com/fr/", "http://COM/de/1",
    "http://xcom/de/", "http://org", "http://org/", "no scheme/a.org/", "", None, "http://a.org:80/x", "x://y://z.org/", "http://u.org?p=://q",
    "http://é.com/fr/é", "http://com./de/", "http:///de/", "http://a..com/de/q", "a\nb://n.com/de/\nx", "http://example.org/es",
]


def brute_rule(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("broadcast_rules", [100, 0])
def test_url_rules(spark, broadcast_rules):
    urls = [(i, u, "host", "path") for i, u in enumerate(URLS)] + [(3, URLS[3], "h", "p"), (None, URLS[0], "h", "p"), (None, None, "h", "p")]
    pages = spark.createDataFrame(urls, "page_id long, url string, host string, rule string")
    extra = [*URL_RULES, ("org", "/", "allow"), ("com", "/fr/", "block"), (None, "/", "block"), ("z", None, "block")]
    rules = spark.createDataFrame(extra, "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, rules, broadcast_rules=broadcast_rules).select("key.page_id", "host", "path", "rule", "verdict")
    known = [("com", "/fr/", "block") if r[:2] == ("com", "/fr/") else r for r in URL_RULES]
    assert rows_of(got) == sorted(((i, *brute_rule(u, known)) for i, u, _, _ in urls), key=repr)
    nothing = url_filter.judge_urls(pages, rules.limit(0), broadcast_rules=broadcast_rules)
    assert nothing.where("verdict = 'allow' and rule is null").count() == len(urls)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "".join(chr(33 + (i * i) % 90) for i in range(2_000_000))
    html = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, "same"), (4, "u\r\nX: y", None), (5, "c", ""), (6, "d", "é\r\n\r\nWARC/1.1\r\n"),
            (None, "n", "same"), (None, "n", "only"), (7, "big", big), (1, "http://a", "same"), (8, "z", "\0"), (9, "z", "q")]
    pages = spark.createDataFrame([(*r, "x") for r in html], "page_id long, url string, html string, payload string")
    path = fresh_path(spark, "warc-test")
    warc.write_archives(warc.resolve_revisits(pages.repartition(3)), path)
    least = {}
    for p, _, h in html:
        if p is not None:
            least[h or ""] = min(least.get(h or "", p), p)
    want = []
    for p, _, h in html:
        raw = (h or "").encode()
        first = least.get(h or "")
        again = first is not None and p != first
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    assert rows_of(warc.read_archives(spark, path)) == sorted(want, key=repr)
    # the files are plain gzip files of WARC records
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    text = b"".join(gzip.decompress(bytes(f.content)) for f in files)
    assert text.count(b"WARC-Type: response\r\n") + text.count(b"WARC-Type: revisit\r\n") == len(html)
    assert text.count(big.encode()) == 1 and text.count(b"X:%20y") == 2 and b"\r\nX:" not in text
    nothing = fresh_path(spark, "warc-none")
    warc.write_archives(warc.resolve_revisits(pages.limit(0)), nothing)
    assert warc.read_archives(spark, nothing).count() == 0


def test_gzip_members_end_in_the_separator():
    rng = np.random.default_rng(0)
    raw = [b"", b"a", rng.bytes(70_000), b"x" * ((1 << 24) + 5)]
    content = b"".join(warc.gzip_member(x) + b"\0" for x in raw)
    assert gzip.decompress(content) == b"".join(raw)
    assert list(warc.members(memoryview(content))) == [x for x in raw if x]
    with pytest.raises(ValueError):
        list(warc.members(memoryview(content[:-9])))


def test_byte_coding():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 33, n)).astype(np.uint32)
        control, data = token_files.encode(v)
        assert len(control) == -(-n // 4)
        assert (token_files.decode(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == v).all()


def test_token_files(spark):
    from tokenizers import Tokenizer

    rows = corpus() + [(500, "Ångström A\u030angstro\u0308m e\u0301 \u0301x it's 12,5 <|endoftext|>a\u2028b\u3000c \t\x0b<|startoftext|>\n\u0345 don't", "x"),
                       (501, "ΣΑΣ ΟΔΟΣ. İI ﬁ \u00a0'S 'll", "x"), (501, "ΣΑΣ ΟΔΟΣ. İI ﬁ \u00a0'S 'll", "x")]
    t = Tokenizer.from_file(word_bpe())
    want, start = [], 0
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = rows_of(token_files.tokens_to_files(documents(spark, rows).repartition(5), word_bpe(), by_word=True))
    # rows that share an id may stand in either order
    plain = lambda xs: sorted(((d, n, c) for d, _, n, c in xs), key=repr)
    assert plain(got) == plain(want)
    once = [d for d in {x[0] for x in want} if sum(x[0] == d for x in want) == 1]
    assert [x for x in got if x[0] in once] == sorted((x for x in want if x[0] in once), key=repr)
    assert sorted(x[1] for x in got)[0] == 0 and all(a[1] + a[2] == b[1] for a, b in itertools.pairwise(sorted(got, key=lambda x: x[1])))
    whole = token_files.tokens_to_files(documents(spark, rows[:20]), word_bpe())
    cut = token_files.tokens_to_files(documents(spark, rows[:20]), word_bpe(), by_word=True)
    assert plain(rows_of(whole)) == plain(rows_of(cut))
    assert token_files.tokens_to_files(empty(spark), word_bpe(), by_word=True).count() == 0


def test_words_are_normalized_by_the_tokenizer(spark):
    """Some letters compose with a mark in lower case only, and the tokenizer composes before it lower-cases."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_bpe())
    pairs = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"]
    assert all(t.encode(p).ids != t.encode(p.lower()).ids for p in pairs)
    texts = [*pairs, *map(str.lower, pairs), " ".join(pairs) + ". AND. And and, 'S IT'S", "x" + pairs[0] + "a!", "B.C. (D) E\u0301. \u01f0J\u030c"]
    want = sorted(((k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, x in enumerate(texts)
                   for ids in [[*t.encode(x, add_special_tokens=False).ids, 1]]), key=repr)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for by_word in (True, False):
        got = token_files.tokens_to_files(docs, word_bpe(), by_word=by_word).select("doc_id", "n_tokens", "ids_crc32")
        assert rows_of(got) == want


def test_frequent_ids_get_small_ranks(spark):
    docs = documents(spark, [(k, "the the the cat", "a") for k in range(4)])
    ranked = token_files.frequency_ranks(token_files.tokenized(docs, word_bpe(), by_word=True))
    assert [n for _, n in ranked] == sorted((n for _, n in ranked), reverse=True) and ranked[0][1] == 12


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><p>Site name, a long slogan here.</p></header>
<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><div class="cookie-notice">We use cookies, and more cookies. Accept all of them, please.</div>
<div class="ad">Buy this, now. Really, buy it.</div><article><h1>The &amp; title</h1><p><b>First <i>para</i>graph,<br>with a break.<p>Second&nbsp;one,
 split.<script>var t="</p>";</script> Goes on.</p><ul><li>An item, too<li>Another item.</ul><!-- <p>no</p> --></article>
<section id="comments"><p>I liked this article a lot, thank you for it. Please write more.</p></section><aside><p>Related: a story, with text.</p></aside>
<form><p>Your mail, please.</p><button>Go</button></form><footer>&copy; 2024, all rights reserved.</footer>"""


def test_main_text():
    assert html_extract.main_text(PAGE) == (
        "The & title\nFirst paragraph, with a break.\nSecond one, split. Goes on.\nAn item, too\nAnother item.")
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<p>") == ""
    assert html_extract.main_text("plain text, no tags. a < b") == "plain text, no tags. a < b"
    assert html_extract.main_text("<article><p>x<script>var a") == "x"
    assert html_extract.main_text("<div>" * 3000 + "deep text, here.") == "deep text, here."


def test_quotes_open_values_only():
    body = "<article><p>Before it, some text.</p>{}<p>After it, more text; it goes on.</p><p>And on, it's said.</p></article>"
    for tag in ("<p title=it's>One, two.</p>", '<p title=5">One, two.</p>', "<p it's>One, two.</p>", '<p "x>One, two.</p>', "<p a=b'c\"d>One, two.</p>",
                '<p title="a > b">One, two.</p>', "<p title='a > \"b'>One, two.</p>", "<p title = 'a>b' x>One, two.</p>", '<p href=x?a="b>One, two.</p>', "<p a= >One, two.</p>"):
        assert html_extract.main_text(body.format(tag)) == "Before it, some text.\nOne, two.\nAfter it, more text; it goes on.\nAnd on, it's said.", tag
    assert html_extract.main_text('<p>a, b.</p><p title="never closed>c') == "a, b."


def test_captions_stay():
    for around in ("<article>{}</article>", "<div><div>{}</div></div>"):
        got = html_extract.main_text(article_of("<figure><img src=a><figcaption>A caption</figcaption></figure>", around=around)).split("\n")
        assert got[1] == "A caption" and len(got) == 3


def test_notices_and_threads_of_any_name_go():
    want = html_extract.main_text(article_of())
    note = "<p>We keep data about you, and we share it with others; read on, or agree. </p>" * 3
    for name in ("gdpr-notice", "site_cookies-bar", "legal notice", "my-newsletter-box", "top consent-layer"):
        assert html_extract.main_text(article_of().replace("<nav>", f'<div class="{name}">{note}</div><nav>')) == want, name
    said = "<p>I liked this a lot, thank you; please write more of it, and soon. </p>" * 4
    for name in ("discussion-thread", "answers", "talk"):
        assert html_extract.main_text(article_of().replace("<footer>", f'<div class="{name}">{said}</div><footer>')) == want, name


def article_of(*parts, around="<article>{}</article>"):
    long = "A paragraph of the article, with some marks in it; it is long, and it goes on. " * 5
    return f"<body><nav><a href=/>Home</a></nav>{around.format(f'<p>{long}</p>' + ''.join(f'{x}<p>{long}</p>' for x in parts))}<footer>All rights.</footer>"


@pytest.mark.parametrize("around", ["<article>{}</article>", '<main><div class="text">{}</div></main>', "<div><div>{}</div></div>", "{}"])
@pytest.mark.parametrize("n", [3, 5, 6, 12, 20])
def test_short_blocks_of_an_article_stay(around, n):
    items = [f"Item {k} of the list" for k in range(n)]
    cells = [f"cell {k}" for k in range(n)]
    parts = {
        "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>": items,
        "<ol>" + "".join(f"<li><p>{x}</p>" for x in items) + "</ol>": items,
        "<table><tbody>" + "".join(f"<tr><td>{x}</td></tr>" for x in cells) + "</tbody></table>": cells,
        "<pre>x = 1</pre>" * n: ["x = 1"] * n,
        "<blockquote>Short</blockquote>" * n: ["Short"] * n,
    }
    for part, want in parts.items():
        got = html_extract.main_text(article_of(part, around=around)).split("\n")
        assert got[1:-1] == want, part
    got = html_extract.main_text(article_of(*parts, around=around)).split("\n")
    assert [x for x in got if not x.startswith("A paragraph")] == [x for want in parts.values() for x in want]


@pytest.mark.parametrize("around", [
    '<div class="content sidebar-right">{}</div>', '<div class="nav-collapsed wrapper">{}</div>', '<div class="header-fixed">{}</div>',
    '<section class="commentary">{}</section>', '<form action="/x">{}</form>', '<form><div id="sidebar">{}</div></form>',
    '<div class="page-header"><main>{}</main></div>', '<form><div class="nav menu"><article>{}</article></div></form>'])
def test_wrappers_with_the_article_stay(around):
    want = html_extract.main_text(article_of("<ul><li>One item</li></ul>"))
    aside = '<div class="cookie-notice">We use cookies, all of them.</div><form><p>Your mail, please.</p></form>'
    page = article_of("<ul><li>One item</li></ul>", around=around)
    assert html_extract.main_text(page) == html_extract.main_text(page.replace("<nav>", aside + "<nav>")) == want


def test_named_elements_beside_the_article_go():
    long = "I liked this a lot, thank you; please write more of it, and soon. " * 40
    want = html_extract.main_text(article_of())
    for beside in (f'<section id="comments"><p>{long}</p></section>', f'<div class="comment-list"><article class="comment-body"><p>{long}</p></article></div>',
                   f'<form><p>{long}</p></form>', f"<footer><p>{long}</p></footer>", '<div class="related-links"><p>A story, with text.</p></div>'):
        assert html_extract.main_text(article_of().replace("<footer>", beside + "<footer>")) == want, beside
    # part of the article
    got = html_extract.main_text(article_of(f'<section class="commentary"><p>{long}</p></section>'))
    assert long.strip() in got.split("\n")


def test_link_lists_and_what_stands_outside_go():
    links = "<ul>" + "".join(f"<li><a href=/{k}>Another page {k}</a></li>" for k in range(8)) + "</ul>"
    text = html_extract.main_text(article_of(links).replace("<footer>", "<div>" + "<p>Short line</p>" * 5 + "</div><footer>"))
    assert {x[:11] for x in text.split("\n")} == {"A paragraph"}


def test_extraction_recovers_articles(spark):
    """On the generated pages the article is what stands in its element: compare with a plain reading of it."""
    import re
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out, name = html_extract.extract_text(pages)
    assert set(pages.columns) < set(out.columns)
    wrong = 0
    for r in out.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", x))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        wrong += r[name].text != "\n".join(x for x in parts if x)
        assert r[name].n_chars == len(r[name].text)
    assert wrong == 0


def test_extraction_edge_rows(spark):
    rows = [(1, None, "u", "m"), (2, "", None, "m"), (3, PAGE, "u", "m"), (3, PAGE, "u", "m"), (None, "<p>a, b.", "u", None)]
    out, name = html_extract.extract_text(spark.createDataFrame(rows, "page_id long, html string, url string, main string"))
    assert name == "main_" and out.count() == 5
    assert html_extract.extract_text(out.select("page_id", "html").limit(0))[0].count() == 0


def brute_seats(claims, seats):
    won = [0] * len(claims)
    for _ in range(seats):
        i = max(range(len(claims)), key=lambda k: (claims[k] / (2 * won[k] + 1), -k))
        won[i] += 1
    return won


def test_apportion_is_sainte_lague():
    rng = np.random.default_rng(4)
    for _ in range(60):
        claims = (rng.integers(0, 1000, rng.integers(1, 9)) ** 2).tolist()
        seats = int(rng.integers(0, 60))
        assert mixing.apportion(claims, seats) == (brute_seats(claims, seats) if sum(claims) else [0] * len(claims))


def test_shard_quotas_are_sainte_lague(spark):
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for src in range(6):
        words = rng.integers(1, 400, rng.integers(1, 30)).tolist()
        blocks = int(rng.integers(0, 90))
        rows += [(src, k, w, sum(words), blocks) for k, w in enumerate(words)]
        want.update({(src, k): q for k, q in enumerate(brute_seats(words, blocks))})
    shards = spark.createDataFrame(rows, "src long, shard long, words long, source_words long, blocks long")
    assert {(r.src, r.shard): r.quota for r in mixing.shard_quotas(shards).collect()} == want


def test_targets_stop_and_share_again():
    assert mixing.source_targets([100, 100, 100], [5, 2, 1], 450) == [200.0, 166.66666666666666, 83.33333333333333]
    assert mixing.source_targets([10, 0, 1000], [5, 2, 1], 1515) == [20.0, 0.0, 1495.0]
    assert mixing.source_targets([], [], 0) == [] and mixing.source_targets([0], [5], 0) == [0.0]


@pytest.mark.parametrize("shard_words", [mixing.SHARD_WORDS, 2000])
def test_mixing(spark, shard_words):
    rows = corpus()
    docs = documents(spark, rows)
    out = mixing.mix_sources(docs, keep=["source"], shard_words=shard_words)
    got = out.select("source", "mix.*").collect()
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted((repr(d), len(WORD.findall(t or ""))) for d, t, _ in rows)
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
    for s in target:
        shards = -(-size[s] // shard_words)
        assert abs(taken[s] - target[s]) <= mixing.BLOCK_WORDS * (1 + shards / 2)
    assert all(r.source_size == size[r.source] for r in got)
    again = mixing.mix_sources(docs.repartition(7), keep=["source"], shard_words=shard_words)
    assert rows_of(again.select("source", "mix.*")) == rows_of(out.select("source", "mix.*"))
    assert mixing.mix_sources(empty(spark)).count() == 0


def brute_taken(rows, shard_of, quota, start_of):
    """Words taken of each row: the quota's blocks read round a shard from its start, word by word."""
    out = {}
    shards = defaultdict(list)
    for r in rows:
        shards[shard_of[r[0]]].append(r)
    for shard, held in shards.items():
        words = [i for _, i, size in sorted((key, i, size) for i, size, key in held) for _ in range(size)]
        count = defaultdict(int)
        wanted = min(quota.get(shard, 0) * mixing.BLOCK_WORDS, 2 * len(words))
        for k in range(wanted):
            count[words[(start_of(shard, len(words)) + k) % len(words)]] += 1
        for i, size, _ in held:
            out[i] = count[i]
    return out


def test_words_taken_are_those_of_the_quotas(spark):
    """Each document's taken words, against reading the shards word by word."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    rows = [(k, " ".join(["w"] * int(rng.integers(0, 90))), f"s{int(rng.integers(0, 2))}") for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.mix.doc_id: r.mix for r in mixing.mix_sources(docs, shard_words=1500).collect()}
    names = sorted({s for *_, s in rows})
    sizes = [sum(len(t.split()) for _, t, s in rows if s == n) for n in names]
    targets = mixing.source_targets(sizes, mixing.WEIGHTS[: len(names)], sum(sizes) * 1.5)
    seats = mixing.apportion(targets, round(sum(targets) / mixing.BLOCK_WORDS))
    src = F.struct(F.lit(False).alias("src_null"), F.col("source").alias("src_name"))
    size = mixing.n_words("text")
    hashed = docs.select("doc_id", "source", size.alias("size"), F.xxhash64(F.lit(mixing.SEED), "doc_id", size, F.xxhash64("text")).alias("key"))
    for name, words, blocks, target in zip(names, sizes, seats, targets, strict=True):
        n = -(-words // 1500)
        mine = hashed.where(F.col("source") == name).withColumn("shard", F.pmod(F.xxhash64(F.lit(mixing.SEED + 1), "doc_id", "key"), F.lit(n).cast("long")))
        rows_ = mine.select("doc_id", "size", "key", "shard", F.xxhash64(F.lit(mixing.SEED + 2), src, "shard").alias("start")).collect()
        per = defaultdict(int)
        for r in rows_:
            per[r.shard] += r.size
        used = sorted(s for s in per if per[s])
        quota = dict(zip(used, brute_seats([per[s] for s in used], blocks), strict=True))
        start = {r.shard: r.start for r in rows_}
        want = brute_taken([(r.doc_id, r.size, r.key) for r in rows_], {r.doc_id: r.shard for r in rows_}, quota,
                           lambda s, w: start[s] % max(w // mixing.BLOCK_WORDS, 1) * mixing.BLOCK_WORDS)
        assert {d: got[d].taken for d in want} == want
        assert all(got[d].target == target and got[d].source_size == words for d in want)


def legal(roles):
    state = 0
    for r in roles:
        here = chat_format.ROLES.index(r) + 1
        if not (state == 0 and here in (1, 2) or state == 1 and here == 2 or state == 2 and here == 3 or state == 3 and here == 2):
            return False
        state = here
    return state in (0, 3)


def brute_cost(roles):
    """Least cost over all labellings and merges, empty turns filled in by search."""
    best = 10**9
    for labels in itertools.product(chat_format.ROLES, repeat=len(roles)):
        cost0 = sum(chat_format.RELABEL * (a != b) for a, b in zip(roles, labels, strict=True))
        for merges in itertools.product((False, True), repeat=max(0, len(roles) - 1)):
            if any(m and labels[i] != labels[i + 1] for i, m in enumerate(merges)):
                continue
            turns = [labels[0]] + [labels[i + 1] for i, m in enumerate(merges) if not m]
            cost = cost0 + chat_format.MERGE * sum(merges)
            fill = fewest_fills(tuple(turns))
            if fill is not None:
                best = min(best, cost + chat_format.INSERT * fill)
    return best


def fewest_fills(turns):
    """Fewest turns to put in so that the sequence is legal (at most two in each gap)."""
    states = {0: 0}
    step = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}

    def spread(s):
        for _ in range(3):
            for a in list(s):
                for b in step[a]:
                    s[b] = min(s.get(b, 99), s[a] + 1)
        return s

    for t in turns:
        here = chat_format.ROLES.index(t) + 1
        open_ = spread(dict(states))
        states = {here: min((c for s, c in open_.items() if here in step[s]), default=None)}
        if states[here] is None:
            return None
    done = spread(dict(states))
    return done.get(3)


def test_repair_costs_are_least():
    for n in range(1, 5):
        for roles in itertools.product([*chat_format.ROLES, None], repeat=n):
            moves = chat_format.repair(list(roles))
            cost = sum(c for *_, c in moves) + int(chat_format.CLOSING[moves[-1][0]])
            assert cost == brute_cost(roles), roles
            out = []
            for state, merged, fill, _ in moves:
                out += [chat_format.ROLES[x - 1] for x in fill] + ([] if merged else [chat_format.ROLES[state - 1]])
            out += [chat_format.ROLES[x - 1] for x in chat_format._CLOSE[moves[-1][0]]]
            assert legal(out)


@pytest.mark.parametrize("segment,ranges", [(chat_format.SEGMENT, None), (3, None), (3, 6), (1, 40)])
def test_chats_by_segments(spark, segment, ranges):
    rng = np.random.default_rng(8)
    rows = []
    for conv in range(12):
        for turn in range(int(rng.integers(1, 40))):
            rows.append((conv, turn, ["system", "user", "assistant", "tool", None][int(rng.choice(5, p=[0.05, 0.45, 0.4, 0.05, 0.05]))], f"t{turn}"))
    rows += [(20, None, "user", "x"), (20, 1, "assistant", None), (20, 1, "assistant", None), (20, 0, "user", ""), (None, 0, "user", "n"), (None, 9, None, "m")]
    # all turns without a number, and all turns with the same
    rows += [(30, None, ["user", "assistant", None][k % 3], f"n{k % 70}") for k in range(300)]
    rows += [(31, 7, ["user", "assistant"][k % 2], f"n{k}") for k in range(200)]
    chats = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, rendered string")
    got = chat_format.repair_chats(chats, segment=segment, ranges=ranges).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.conv_id].append(r)
    for conv, parts in by.items():
        parts.sort(key=lambda r: (r.seg, r.k))
        text = "".join(r.rendered for r in parts)
        roles = [line[2:-2] for line in text.split("\n") if line.startswith("<|") and line != "<|end|>"]
        assert legal(roles) and text.count("<|end|>\n") == len(roles)
        key = lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "")
        mine = sorted((r for r in rows if r[0] == conv), key=key)
        whole = chat_format.repair([r[2] for r in mine])
        assert sum(r.cost for r in parts) == sum(c for *_, c in whole) + int(chat_format.CLOSING[whole[-1][0]])
        assert [r.last for r in parts] == [False] * (len(parts) - 1) + [True]
    assert chat_format.repair_chats(chats.limit(0)).count() == 0
