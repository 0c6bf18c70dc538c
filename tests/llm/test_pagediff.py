"""Main text: markup by hand, alignment against plain dynamic programming, partners against plain sorting."""

import random
from collections import Counter

from longspan.llm import pagediff as P


def text(page, partner=None):
    lines = P.page_lines(page)
    return P.main_text(lines, P._hash_lines(P.page_lines(partner)) if partner else None, P._hash_lines(lines))


def test_markup():
    page = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body><nav><ul><li>'
            '<a href="/x">x</a></li></ul></nav><!-- ad <p>0</p> --><div class="ad">Buy</div><article><h1>A &amp; B&amp;&amp;</h1><p><b>One\n two'
            '<br><p>Three&nbsp;&#233;<div class="comments"><p>reader</p></div><p>Four</p></article><footer>&copy; f</footer>')
    assert text(page) == "A & B&&\nOne two\nThree é\nFour"
    assert text("") == "" and text("plain <3 text & more") == "plain <3 text & more"
    assert text("<p>a<b>b</b>c</p> <p> </p><pre>d\n\n e</pre>") == "abc\nd e"
    assert text("<nav>menu<article><p>in</p></article>") == "in"
    assert text("<body><form>f<p>g</p></form><aside>s</aside><textarea><p>no</textarea><main>m<select><option>o</select></main>") == "m"
    assert text("<div id='cookie-notice'>c<div>d</div></div><p role=navigation>n</p><p class=news>kept</p>") == "kept"
    assert text("<script>never closed <p>x") == "" and text("<p>open <b") == "open"


def test_differencing_where_no_article_is_named():
    a = "<body><div>Site name</div><p>Only here</p><div>Read more</div><div>Imprint</div></body>"
    b = "<body><div>Site name</div><p>Other text</p><p>Second</p><div>Imprint</div></body>"
    assert text(a, b) == "Only here\nRead more" and text(b, a) == "Other text\nSecond"
    art = "<div>Site name</div><article><p>Shared sentence</p></article>"
    assert text(art, art) == "Shared sentence" and text(a, a) == ""


def test_differencing_decides_beside_a_named_article():
    """What the partner does not account for is text, whatever else is called an article; lines of an article stay."""
    frame = "<body><div>Site name</div>{}<div>Imprint</div></body>"
    a = frame.format("<p>Long story</p><article><p>Teaser</p></article><p>Its end</p>")
    b = frame.format("<p>Another story</p><article><p>Teaser</p></article>")
    assert text(a, b) == "Long story\nTeaser\nIts end" and text(b, a) == "Another story\nTeaser"
    assert text(a) == "Teaser"


def test_differencing_reaches_pages_that_name_an_article(spark):
    frame = "<div>Site name</div><p>story {}</p><main><p>part {}</p><p>shared</p></main><nav>menu</nav>"
    rows = [(k, f"http://h/{k}", frame.format(k, k)) for k in range(4)] + [(9, "http://alone/", frame.format(9, 9))]
    by = {r.page_id: r.text for r in P.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert by == {k: f"story {k}\npart {k}\nshared" for k in range(4)} | {9: "part 9\nshared"}


def length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment(monkeypatch):
    rng = random.Random(3)
    for limit in (1 << 28, 60):
        monkeypatch.setattr(P, "_ROWS", limit)
        for _ in range(300):
            k = rng.choice([2, 5, 40])
            a, b = ([rng.randrange(k) for _ in range(rng.randrange(30))] for _ in range(2))
            places = P.common_subsequence(a, b)
            assert places == sorted(set(places)) and len(places) == length(a, b)
            it = iter(b)
            assert all(a[i] in it for i in places)


def test_partners(spark):
    rng = random.Random(1)
    rows = [(i, i % 3, rng.choice(["big"] * 5 + ["a", "b", "c", "d"]), f"/{rng.randrange(4)}/{rng.randrange(60)}", [i]) for i in range(400)]
    rows += [(400, 0, "lonely", "/", [400]), (401, 0, "last", "", [])]
    df = spark.createDataFrame(rows, "k1 bigint, k2 bigint, host string, path string, hashes array<bigint>")
    order = sorted(rows, key=lambda r: (r[2], r[3], r[0]))
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for size in ("1b", "64m"):  # many partitions, and one
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40" if size == "1b" else "1")
        got = {r.k1: r.partner for r in P.partners(df.repartition(5)).collect()}
        for k, r in enumerate(order):
            back = order[k - 1] if k and order[k - 1][2] == r[2] else None
            after = order[k + 1] if k + 1 < len(order) and order[k + 1][2] == r[2] else None
            best = max((x for x in (back, after) if x), key=lambda x: (common(r[3], x[3]), x is back), default=None)
            assert got[r[0]] == (best[4] if best else None), r
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_lines_travel_whole():
    lines = [P.Line("a\x00b é", 1), P.Line("\ud800", 0), P.Line("z" * 9, 2)]
    assert P._unpack(P._pack(lines)) == lines and P._unpack(P._pack([])) == []


def test_query(spark):
    common = "<div>Head line</div><div>Foot line</div>"
    rows = [(1, "http://h/a/1", f"{common}<p>one</p>"), (2, "http://H:80/a/2", f"{common}<p>two</p>"), (3, "http://other/", f"{common}<p>x</p>"),
            (4, None, None), (None, "::bad[", "<article>é</article>"), (1, "http://h/a/1", f"{common}<p>one</p>"), (5, "http://h/z", "<p>" + "w " * 50_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = P.extract(pages).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter(r[:2] for r in rows)
    by = {r.page_id: r.text for r in got}
    assert by[2] == "two" and by[3] == "Head line\nFoot line\nx" and by[4] == "" and by[None] == "é" and by[5] == ("w " * 50_000).strip()
    assert all(r.n_chars == len(r.text) for r in got)
    assert P.extract(pages.limit(0)).count() == 0


def test_copies_keep_their_text(spark):
    """Exact copies (other id or query) and near copies without a named article."""
    common = "<div>Head line</div><div>Foot line</div>"
    story = "".join(f"<p>sentence {i}</p>" for i in range(40))
    own = "\n".join(f"sentence {i}" for i in range(40))
    rows = [(1, "http://h/a/1", common + story), (2, "http://h/a/1?page=2", common + story), (3, "http://h/a/1", common + story),
            (4, "http://h/b", f"{common}<p>else</p>"), (5, "http://alone/", common + story), (6, "http://alone/?x=1", common + story),
            (7, "http://near/1", common + story + "<p>at noon</p>"), (8, "http://near/2", common + story + "<p>at night</p>")]
    by = {r.page_id: r.text for r in P.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert by[1] == by[2] == by[3] == own and by[4] == "else"
    assert by[5] == by[6] == f"Head line\nFoot line\n{own}"
    assert by[7].endswith(f"{own}\nat noon") and by[8].endswith(f"{own}\nat night")
