"""Token ids, license scan, decontamination and pages against brute force and plain cases."""

import hashlib
import random
import re
import struct
import time

import pytest
import tiktoken

from tillgrain.llm import bpe, decontaminate, html_text, licenses

ODD = [None, "", " ", "a", "it's we'll 12 ab12", "é中文  x", " " * 70_000 + "end", "ab " * 40_000,
       "x" * 300_000, "\n\n tab\t", "a", "a"]


def test_ids_are_those_of_the_library(documents):
    docs = documents(list(enumerate(ODD)))
    codec: tiktoken.Encoding = bpe.encoding(bpe.RANKS)
    coded = bpe.decode(bpe.encode(docs), into="decoded")
    assert set(coded.columns) == set(docs.columns) | {"decoded"}
    for row in coded.collect():
        text = ODD[row["doc_id"]] or ""
        assert row["ids"] == codec.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()


def test_packed_ids_are_little_endian(documents):
    row = bpe.encode(documents([(1, "hello world")]), as_bytes=True).first()
    ids = bpe.encode_text("hello world")
    assert bytes(row["ids"]) == struct.pack(f"<{len(ids)}I", *ids)
    assert bpe.packed([]) == b"" and hashlib.sha256(b"").hexdigest()


def test_a_run_too_long_for_the_library_round_trips():
    text = "x" + " " * 1_500_000 + "y"
    assert bpe.encoding(bpe.RANKS).decode_bytes(bpe.encode_text(text)) == text.encode()


def test_empty_tables(documents):
    none = documents([])
    assert bpe.encode(none).count() == 0
    assert licenses.scan(none).count() == 0
    assert decontaminate.find_leaks(none, none.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_license_scan_counts_places_and_templates(documents):
    notice = licenses.TEMPLATES["mit-notice"]
    texts = ["Under the GNU  General-Public\nLicense. MIT license; mit LICENSE", notice.upper(),
             "x\n" + " ".join(notice.split()[:-1]) + "\ny", None, "license mit by cc", ""]
    rows = {r["doc_id"]: r for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    first = rows[0]
    assert (first["n_words"], first["n_base"], first["first_word"], first["last_word"]) == (10, 3, 2, 8)
    assert first["base_labels"] == "gpl,mit" and first["score"] == 1.0
    assert rows[1]["labels"] == "mit-notice" and rows[1]["score"] == 1.0 and rows[1]["n_base"] == 0
    assert rows[2]["labels"] == "mit-notice" and 0.9 <= rows[2]["score"] < 1
    assert rows[2]["blocks"] == [1]
    for n in (3, 4, 5):
        assert rows[n]["labels"] == "" and rows[n]["score"] == 0 and rows[n]["first_word"] is None


def windows(template, words, threshold, span):
    """The largest share that a window holds, and the windows that meet the template: plainly, all."""
    own, width = set(template), max(len(template), int(span * len(template) + 1e-9))
    shares = [(len(own & set(words[n:n + width])) / len(own), n) for n in range(len(words))]
    met = [(s, n) for s, n in shares if s >= threshold - 1e-9 and words[n] in own]
    return max(met)[0] if met else 0.0, [n for _, n in met]


def test_the_filters_lose_no_block():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    templates = {f"t{n}": " ".join(draw.choices(words, k=draw.randint(1, 12))) for n in range(12)}
    ready = licenses.Templates(templates, 0.7, {w.encode(): draw.randint(0, 9) for w in words}, 1.5)
    some = 0
    for _ in range(300):
        body = draw.choices(words[:draw.randint(4, 30)], k=draw.randint(0, 60))
        for label in draw.choices(sorted(templates), k=2):
            part = templates[label].split()
            draw.shuffle(part)
            at = draw.randint(0, len(body))
            body[at:at] = part[:draw.randint(0, len(part))]
        brute = {label: got for label, t in templates.items()
                 if (got := windows(t.split(), body, 0.7, 1.5))[0]}
        found = ready.matches([w.encode() for w in body], {w.encode() for w in body})
        assert {label: (share, sorted(at)) for label, (share, at) in found.items()} == brute
        some += len(brute)
    assert some > 300


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law"""


def test_wrapped_and_commented_notices_are_blocks(documents):
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are "
           "permitted provided that the following conditions are met:")
    draw = random.Random(11)
    texts = [bsd, "x = 1\n\n" + bsd + "\n\ny = 2", bsd.replace("without\n", "without\n\n"), APACHE,
             "/*\n" + "\n".join(" * " + line for line in APACHE.split("\n")) + "\n */\nint main"]
    for label in sorted(licenses.TEMPLATES):
        words = licenses.TEMPLATES[label].split()
        for mark in ("", "# ", " * ", "// "):
            at = sorted(draw.sample(range(1, len(words)), min(3, len(words) - 1)))
            lines = [mark + " ".join(words[a:b]) for a, b in zip([0, *at], [*at, len(words)])]
            drop = draw.choice([0, 0, 1])
            texts.append("\n".join(["import os", mark.rstrip(), *lines[drop:], mark.rstrip(), "end"]))
    rows = {r["doc_id"]: r for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    plain = {label: licenses.words_of(t.encode()) for label, t in licenses.TEMPLATES.items()}
    for n, text in enumerate(texts):
        numbered = [(w, k) for k, line in enumerate(text.split("\n"))
                    for w in licenses.words_of(line.encode())]
        got = {label: windows(t, [w for w, _ in numbered], 0.9, 1.5) for label, t in plain.items()}
        row = rows[n]
        assert set(row["labels"].split(",")) - {""} == {label for label, (share, _) in got.items() if share} \
            | set(row["base_labels"].split(",")) - {""}
        assert row["blocks"] == sorted({numbered[a][1] for _, at in got.values() for a in at})
        if not row["n_base"]:
            assert row["score"] == pytest.approx(max(share for share, _ in got.values()))
    assert all(rows[n]["labels"] == "bsd-notice" for n in (0, 1, 2))
    assert rows[0]["blocks"][0] == 0 and rows[1]["blocks"][0] == 2
    assert all(rows[n]["labels"] == "apache,apache-2.0-notice,apache-line" for n in (3, 4))


def test_scattered_words_are_no_notice(documents):
    filler = " filler" * 1200
    texts = ["The MIT campus paper said the new album was released in May" + filler + " under a bridge"
             + filler + " a driving license",
             "Apache helicopters were licensed to pilots under the old rule; no fishing license was needed",
             filler.join(licenses.TEMPLATES["isc-notice"].split()),
             "Released" + filler + " under the MIT" + filler + " Released under the MIT License" + filler]
    rows = {r["doc_id"]: r for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    assert [(rows[n]["labels"], rows[n]["score"], rows[n]["blocks"]) for n in range(3)] == [("", 0, [])] * 3
    assert rows[3]["labels"] == "mit,mit-line" and rows[3]["blocks"] == [0]


def edits(pattern, text):
    """Fewest edits between the pattern and a part of the text, by the plain table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(new[-1] + 1, row[i] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_myers_distance_is_that_of_the_table():
    draw = random.Random(3)
    for _ in range(200):
        pattern = "".join(draw.choices("abc ", k=draw.randint(1, 90)))
        text = "".join(draw.choices("abc ", k=draw.randint(0, 120)))
        assert decontaminate.Pattern(pattern).best(text)[0] == edits(pattern, text)


def test_every_item_within_its_budget_is_found():
    draw = random.Random(8)
    item = " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(30))
    items = decontaminate.Items(((1, item),), 0.05, 24)
    budget = int(0.05 * len(item))
    for wanted in range(0, budget + 4):
        for _ in range(20):
            changed = list(item)
            for at in draw.sample(range(len(item)), wanted):
                changed[at] = draw.choice(["", "z", "zz"]) if draw.random() < 0.9 else changed[at]
            text = "lead in " + "".join(changed) + " and out"
            assert bool(items.find(text)) == (edits(item, text) <= budget)


def test_leaks_with_their_characters(documents, spark):
    item = "The quick brown fox jumps over the lazy dog, twice a day."
    texts = [f"Before. {item} After.", item.upper().replace(" ", "  "), None, "", "clean words only",
             f"{item}\n{item}"]
    marks = spark.createDataFrame([(7, item), (8, None), (9, "short"), (7, item)],
                                  "item_id bigint, text string")
    docs = documents(list(enumerate(texts)))
    found = decontaminate.find_leaks(docs, marks).distinct().collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(0, 7), (1, 7), (5, 7), (5, 7)]
    for r in found:
        assert decontaminate.normal(texts[r["doc_id"]][r["start"]:r["end"]]) == \
            decontaminate.normal(item)
    left = decontaminate.without_leaks(docs, marks)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]
    many = decontaminate.find_leaks(docs, marks, block_chars=10).distinct()
    assert many.count() == len(found)


def test_short_items_are_found_as_whole_words(documents, spark, caplog):
    items = [(1, "Who wrote Emma?"), (2, "E = mc^2"), (3, "今天天气怎么样？"), (4, "ha ha"), (5, "?! -"),
             (6, None), (7, "Solve for x: 3x + 5 = 20"), (8, "one more item of 24 chars or so")]
    texts = ["He asks: who  WROTE emma", "who wrote emmaline", "awho wrote emma", "so E=mc^2 holds",
             "e mc 22", "他问：今天天气怎么样。", "ha, ha! ha", "who wrote emna", "?! -", None,
             "solve for x 3x 5 21", "Solve for X, 3x+5=20.", "one more item of 24 charz or so"]
    marks = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(list(enumerate(texts)))
    want = []
    for n, text in enumerate(texts):
        words = decontaminate.normal(text or "").split()
        for i, item in items[:-1]:
            own = decontaminate.normal(item or "").split()
            want += [(n, i, 0) for a in range(len(words)) if own and words[a:a + len(own)] == own]
    want.append((12, 8, 1))
    with caplog.at_level("WARNING"):
        found = decontaminate.find_leaks(docs, marks).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in found) == sorted(want)
    assert {(0, 1), (3, 2), (5, 3), (6, 4), (11, 7)} <= {(n, i) for n, i, _ in want}
    assert "2 items without any word" in caplog.text
    for r in found:
        if r["item_id"] != 8:
            assert decontaminate.normal(texts[r["doc_id"]][r["start"]:r["end"]]) == \
                decontaminate.normal(dict(items)[r["item_id"]])
    left = {r["doc_id"] for r in decontaminate.without_leaks(docs, marks).collect()}
    assert left == set(range(len(texts))) - {n for n, _, _ in want}
    assert decontaminate.item_counts(marks) == {"edits": 1, "exact": 5, "none": 2}


PAGE = ("<html><head><title>T</title></head><body><nav><ul><li><a>Home</a></li></ul></nav>"
        "<div class='ad'>Buy now</div><article><h1>A &amp; B</h1><p>One  two\nthree four <b>five</b>"
        "<br>six<p>Seven eight nine ten</p><form>Name</form></article>"
        "<div id='comments'><p>First to say so</p></div><footer>Made here</footer></body></html>")


def test_main_text_of_pages(spark):
    plain = PAGE.replace("article>", "div>")
    rows = [(1, "u", PAGE), (2, None, plain), (3, "u", None), (4, "u", ""), (5, "u", "<p"),
            (6, "u", "just words"), (7, "u", "<p>" + "word " * 200_000), (1, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in
           html_text.extract(pages, html_text.learn_weights(pages)).collect()]
    wanted = "A & B\n\nOne two three four five six\n\nSeven eight nine ten"
    texts = dict((i, t) for i, t, _ in got)
    assert texts[1] == texts[2] == wanted and len(got) == 8
    assert texts[3] == texts[4] == texts[5] == "" and texts[6] == "just words"
    assert len(texts[7].split()) == 200_000
    assert all(n == len(t) for _, t, n in got)


@pytest.mark.parametrize("tag,kept", [
    ('<p class="x"">', True), ("<p title=Don't>", True), ("<p data-a='b'' c>", True),
    ('<p title=a="b>', True), ('<p "quoted" x>', True), ("<p title='5 > 4'>", True),
    ('<p title="The hidden cost of sugar">', True), ('<p class="mb-4 hidden md:block">', True),
    ('<p title="aria-hidden=true display:none id=ad">', True), ('<section id="related-work">', True),
    ('<section id="search">', True), ('<h2 id="navigation">', True),
    ('<div class="section" id="notice">', True), ("<p title = 'x' hidden>", False),
    ('<p HIDDEN="">', False), ("<p aria-hidden=true>", False), ('<p style="display: none">', False),
    ('<section class="related-posts">', False), ("<section role=search>", False),
    ('<div id="comments">', False), ("<div class=ad>", False)])
def test_an_article_keeps_its_passages(tag, kept):
    name = re.match(r"<(\w+)", tag)[1]
    page = (f"<body><div>Menu</div><article><p>Before it.</p>{tag}Passage of it.</{name}>"
            "<p>What \"they\" don't say.</p></article><div id='comments'>First</div></body>")
    wanted = ["Before it.", *["Passage of it."] * kept, 'What "they" don\'t say.']
    assert html_text.main_text(page, html_text.DEFAULT) == "\n\n".join(wanted)


STORY = "<h1>A title</h1><p>One two three four.<p>Five six seven eight nine."
READ = "A title\n\nOne two three four.\n\nFive six seven eight nine."


@pytest.mark.parametrize("page", [
    "<html><head><title>T</title><meta x><body><nav>Menu</nav><div>{}</div></body>",
    "<html><head><title>T</title><div>{}</div>",
    "<div class='page has-sidebar'><nav>M</nav><div>{}</div><div class=sidebar>Side</div></div>",
    "<div class='wrapper no-sidebar'>{}</div><div class='sidebar-left'>Side</div>",
    "<div class='single-post with-comments'>{}</div><div id=comments>First one</div>",
    "<form><nav>Menu</nav><div>{}</div><input></form><footer>Made here</footer>",
    "<form><nav>Menu</nav><article>{}<form>Send me</form></article></form>",
    "<table><tr><td class=menu>Menu here<td>{}</table>",
    "<table><tr><th class=menu>Menu here<tr><td>{}</table>",
    "<dl><dt class=ad>Buy now<dd>{}</dl>",
    "<div class=search><article>{}</article></div><div class=ad>Buy this now</div>",
    "<div hidden><main>{}</main></div><div class=cookieNotice>Take them</div>",
    "<div class=sidebar><article>Teaser</article></div><div>{}</div>",
    "<div>{}</div><ol class=comment-list><li><article class=comment-body>Nice</article></ol>",
    "<article>{}</article><div class=comments>" + "<article class=comment>Many words here</article>" * 9,
    "<body><nav><a>Menu<div></nav><article>{}</article><div class='cookie-bar'>Ok</div></body></html>",
    "<article>{}<video><p>No video</video></article><aside><p>Side</aside>"])
def test_pages_whose_frame_is_no_junk(page):
    assert html_text.main_text(page.format(STORY), html_text.DEFAULT) == READ


@pytest.mark.parametrize("part,kept", [
    ("<span class=ad-hoc>Kept</span>", "Kept"), ("<em class=search-term>Kept</em>", "Kept"),
    ("<em class=share>Kept</em>", "Kept"), ("<div class=share-price-analysis>Kept</div>", "Kept"),
    ("<math><mi>x</mi><annotation>TeX</annotation></math>", "x"), ("AT&amp;T", "AT&T"),
    ("&<b>amp;</b>", "&amp;"), ("<div class=share-buttons>Gone</div>", ""),
    ("<div class=relatedPosts>Gone</div>", ""), ("<aside>Gone</aside>", ""),
    ("<ul><li class=ad>Gone<li>Kept</ul>", "Kept"), ("<em hidden>Gone</em>", "")])
def test_passages_inside_of_an_article(part, kept):
    page = f"<article><p>Before it stands this.</p><div>{part}</div><p>After it this.</p></article>"
    assert html_text.main_text(page, html_text.DEFAULT) == "\n\n".join(
        ["Before it stands this.", *[kept] * bool(kept), "After it this."])


def test_pages_made_from_known_blocks():
    """Trees of blocks and junk, some end tags left out, wrapped anew; their text is known."""
    draw = random.Random(14)
    sentence = lambda: " ".join(draw.choices(["one", "two", "tree", "leaf"], k=draw.randint(4, 9)))
    junk = ["<nav><ul><li><a>{}<li>{}</ul></nav>", "<div class=ad>{}</div>", "<aside><p>{}</aside>",
            "<p class='cookie-notice'>{}</p>", "<script>{}</script>", "<form>{}</form>", "<!-- {} -->"]
    frames = ["{}", "<div>{}</div>", "<div class='page no-sidebar'>{}</div>", "<form>{}</form>",
              "<table><tr><td class=nav>{}<td>{}</table>"]
    for n in range(150):
        made, wanted = [], []
        for _ in range(draw.randint(4, 9)):
            if draw.random() < 0.3:
                made.append(draw.choice(junk).replace("{}", "Gone."))
                continue
            lines = [sentence() for _ in range(draw.randint(1, 3))]
            if len(lines) == 1:
                made.append(draw.choice(["<p>{}", "<p>{}</p>", "<div>{}</div>", "<h2>{}</h2>"]).format(*lines))
            else:
                end = draw.choice(["", "</li>"])
                made.append("<ul>" + "".join(f"<li>{x}{end}" for x in lines) + "</ul>")
            wanted += lines
        body = f"<article>{''.join(made)}</article>"
        for _ in range(draw.randint(0, 3)):
            frame = draw.choice(frames)
            body = frame.format(*["Menu."] * (frame.count("{}") - 1), body)
        page = f"<head><title>T</title>{draw.choice(['', '</head>'])}<body>{draw.choice(junk)}{body}<footer>F"
        assert html_text.main_text(page, html_text.DEFAULT) == "\n\n".join(wanted), page


@pytest.mark.parametrize("tag", ["font", "div", "b class=ad", "li", "p", "td", "article", "dd"])
def test_unclosed_tags_are_read_in_linear_time(tag):
    page = f"<{tag}>word " * 100_000
    begin = time.process_time()
    html_text.main_text(page, html_text.DEFAULT)
    assert time.process_time() - begin < 5


def test_weights_come_from_few_labelled_pages_among_many(spark):
    rows = [(n, PAGE if n == 7 else PAGE.replace("article>", "div>")) for n in range(301)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string")
    weights = html_text.learn_weights(pages, sample=30)
    assert weights != html_text.DEFAULT and weights == html_text.learn_weights(pages.where("page_id = 7"))


def test_the_best_run_is_the_best_of_all_runs():
    draw = random.Random(2)
    for _ in range(100):
        source = "".join(draw.choice(["<p>", "</p>", "<li>", "a b c ", "w "]) for _ in range(14))
        page = html_text.Page(source)
        value = [html_text.DEFAULT[""] * n if not tag else html_text.DEFAULT.get(
            tag, html_text.OTHER_TAG) for tag, _, _, n in page.tokens]
        best = max([sum(value[i:j]) for i in range(len(value)) for j in range(i, len(value) + 1)],
                   default=0)
        a, b = html_text.best_run(page, html_text.DEFAULT)
        assert sum(value[a:b]) == pytest.approx(best)


def test_words_are_found_as_the_contract_says():
    text = "AbC\x00d-É9 中\x7fz"
    wanted = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "abc\x00d-É9 中\x7fz")
    assert [w.decode() for w in licenses.words_of(text.encode())] == wanted
