"""Operators on single rows: pieces, token files, HTML, toxicity, language."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from serieskit.llm import html_text, language, pieces, token_files, toxicity
from serieskit.llm.common import scratch
from serieskit.llm.queries import tokenizer_file
from tests.llm.data import documents, frame, prose

ROWS = documents()
ODD = [
    (1, "  Hello  wörld \n\t a 日本 \x00 x"), (2, "a" * 3000), (3, "aaaa aaa aa"), (4, " "), (5, "<s> </s> <unk> <0x41>"), (6, "😀😀 tests' don't 'street"),
    (7, "https://www.example.com/a?b=c&d=1 0123456789\r\n"), (8, "<|endoftext|> a <|startoftext|>b"), (9, "ΣΑΣ İstanbul ½ ² Ⅷ x1y22"), (10, "a b\x1cc\x85d\xa0e"),
]


def test_pieces_equal_the_library(spark):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = ROWS + ODD
    made = pieces.encode(frame(spark, rows), path)
    got = [(r.doc_id, list(r.ids), r.n_pieces, r.round_trip) for r in made.collect()]
    want = [(d, model.encode(t or "")) for d, t in rows]
    assert sorted(map(str, got)) == sorted(str((d, ids, len(ids), True)) for d, ids in want)
    texts = sorted((str(r.doc_id), r.text) for r in pieces.decode(made, path).collect())
    assert texts == sorted((str(d), t or "") for d, t in rows)
    assert pieces.encode(frame(spark, []), path).count() == 0


def test_blank_sign_in_a_text_is_a_blank(spark):
    row = pieces.encode(frame(spark, [(1, "a ▁b")]), tokenizer_file("piece_bpe_32k.model")).first()
    assert not row.round_trip


def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [(d if d is not None else None, t) for d, t in ROWS + [(1000 + d, t) for d, t in ODD]]
    folder = scratch(spark, "token-files")
    token_files.write_token_files(frame(spark, rows), folder, path, 2, part_bytes=20_000)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, folder).collect()]
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in rows]
    want = sorted(str((d, len(x), zlib.crc32(x.tobytes()))) for (d, _), x in zip(rows, ids))
    assert sorted(str((d, n, c)) for d, _, n, c in got) == want
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    known = [r[0] for r in got if r[0] is not None]
    assert known == sorted(known) and [r[0] for r in got][:2] == [None, None]
    # The same through memory maps of a local folder.
    from pathlib import Path

    parts = sorted(p for p in Path(folder.removeprefix("file:")).iterdir() if p.name.startswith("part-"))
    flat = np.concatenate([b[0] for p in parts for b in token_files.open_part(str(p))])
    assert flat.dtype.itemsize == 2 and zlib.crc32(flat[: got[0][2]].astype("<u4").tobytes()) == got[0][3]
    assert len(flat) == sum(len(x) for x in ids)
    assert token_files.round_trip(frame(spark, []), path).count() == 0


def test_repeated_rows_spread_over_parts(spark, monkeypatch):
    """A third of all rows are one text without an id: parts stay small and starts go on, over several bands of parts."""
    from pathlib import Path

    monkeypatch.setattr(token_files, "BAND_PARTS", 2)
    path, text = tokenizer_file("word_bpe_49k.json"), prose(random.Random(4), 100)
    rows = [(None, text)] * 200 + [(i, prose(random.Random(i), 100)) for i in range(400)]
    folder = scratch(spark, "token-files")
    token_files.write_token_files(frame(spark, rows), folder, path, 2, part_bytes=40_000)
    sizes = [p.stat().st_size for p in Path(folder.removeprefix("file:")).iterdir() if p.name.startswith("part-")]
    assert len(sizes) > 8 and max(sizes) < 3 * sum(sizes) / len(sizes)
    got = sorted((tuple(r) for r in token_files.read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None] * 200 + list(range(400)) and len({r[2:] for r in got[:200]}) == 1
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()


def test_encoder_forgets_and_still_agrees(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_RUNS", 50)
    rng = random.Random(3)
    made = token_files.CachedEncoder(tokenizer_file("word_bpe_49k.json"))
    for _ in range(12):
        batch = ["".join(rng.choice("abXYZ '\"!?.,12½éÉß \n\t_<|>@ſİ²日") for _ in range(50)) + prose(rng, 10) for _ in range(20)]
        want = [np.array(e.ids, made.kind).tobytes() for e in made.tokenizer.encode_batch(batch, add_special_tokens=False)]
        assert made.encode(batch) == want


PAGES = {
    "<html><head><title>T</title><script>if(a<b){x('</p>')}</script></head><body><nav><a href=x>Menu</a></nav><header>Site</header><div class='ad banner'>Buy.</div>"
    "<main><h1>Head &amp; line</h1><p>One  two\n three.<p>Four, <b>five</b> six.<ul><li>a<li>b</ul></main><aside>Side</aside><div id=comments><p>Nice!</p></div><footer>End</footer>": "Head & line\n\nOne two three.\n\nFour, five six.\n\na\n\nb",
    "": "",
    "<p></p><div> \n </div>": "",
    "plain &lt;text&gt; only": "plain <text> only",
    "<div><div class=menu><a>x</a> <a>y</a></div><div class=content><p>A long paragraph, with marks; and more. And again.</p><h2>Sub</h2><p>Next one, that is long enough.</p></div><div><a href=1>l1</a><a href=2>l2</a></div></div>": "A long paragraph, with marks; and more. And again.\n\nSub\n\nNext one, that is long enough.",
    "<article><p>Kept.<form><input><button>Go</button></form><style>p{}</style><p>Too<br>kept &#233;&eacute;</article><p class='cookie-notice'>We use.</p>": "Kept.\n\nToo kept éé",
    "<body><article><p>open tag <b>never closed<p>second": "open tag never closed\n\nsecond",
}


def test_main_text(spark):
    rows = [(i, None if i == 99 else "u", h) for i, h in enumerate(PAGES)] + [(99, None, None), (None, "u", "<p>x</p>"), (0, "u", next(iter(PAGES)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = html_text.extract(pages).collect()
    want = [(i, PAGES.get(h, "x" if i is None else "")) for i, _, h in rows]
    assert sorted((str(r.page_id), r.text) for r in got) == sorted((str(i), t) for i, t in want)
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(pages.limit(0)).count() == 0


LONG = "A long line of this article, with marks; it goes on and on, and then it ends."
PARTS = [f"{LONG} Number {i}." for i in range(20)]
LIST = "<ul>" + "".join(f"<li>{p}" for p in PARTS) + "</ul>"
WHOLE = [
    ("<article><h1>Head</h1><p>A lead.</p>" + LIST + "<p>An end.</p></article>", ["Head", "A lead.", *PARTS, "An end."]),
    ("<main><h1>Head</h1><p>A lead.</p><table>" + "".join(f"<tr><td>{p}</td></tr>" for p in PARTS) + "</table><p>An end.</p></main>", ["Head", "A lead.", *PARTS, "An end."]),
    ("<article><p>A lead.</p><blockquote>" + "".join(f"<p>{p}</p>" for p in PARTS) + "</blockquote><p>An end.</p></article>", ["A lead.", *PARTS, "An end."]),
    ("<article><section>" + "".join(f"<p>{p}</p>" for p in PARTS[:14]) + "</section><section>" + "".join(f"<p>{p}</p>" for p in PARTS[14:]) + "</section></article>", PARTS),
    ("<body><div><div>" + "".join(f"<p>{p}</p>" for p in PARTS[:14]) + "</div><div>" + "".join(f"<p>{p}</p>" for p in PARTS[14:]) + "</div></div><div><a href=1>l1</a></div>", PARTS),
    ("<body><div><p>A lead.</p>" + LIST + "<p>An end.</p></div><div><a href=1>l1</a></div>", ["A lead.", *PARTS, "An end."]),
    ("<body><div><p>A.</p><blockquote><p>" + LONG * 9 + "</p></blockquote><p>B.</p></div>", ["A.", LONG * 9, "B."]),
    ("<table><tr><td><a href=1>l1</a><p><a href=2>l2</a></p></td><td>" + "".join(f"<p>{p}</p>" for p in PARTS) + "</td></tr></table>", PARTS),
]


@pytest.mark.parametrize("page, want", WHOLE)
def test_article_is_whole(page, want):
    assert html_text.main_text(page).split("\n\n") == want


TEXT = "".join(f"<p>{p}</p>" for p in PARTS)
NOISE = f"<p class=promo>{LONG}</p><div id=comments><p>{LONG}</p></div><div class='left-sidebar'><p>{LONG}</p></div>"
MARKED = [
    ("<body><div class='content no-sidebar'>" + TEXT + "</div>" + NOISE, PARTS),
    ("<body><div class='has-sidebar'><div>" + TEXT + "</div></div>" + NOISE, PARTS),
    ("<body><div class=social><article class='post category-social tag-menu'>" + TEXT + NOISE + "</article></div>", PARTS),
    ("<body><div class=page-widget><main class='with-comments related'>" + TEXT + NOISE + "</main></div>", PARTS),
    ("<article><h2 id=related class=nav>Head</h2>" + TEXT + "<section id=notices><p>A notice.</p></section>" + NOISE + "</article>", ["Head", *PARTS, "A notice."]),
    ("<body><div class=banner><div class=side>" + TEXT + "</div></div>" + NOISE, PARTS),
    ("<body><div class=promo><article>" + TEXT + "</article></div><div class=promo><article><p>B.</p></article></div>" + NOISE, [*PARTS, "B."]),
]


@pytest.mark.parametrize("page, want", MARKED)
def test_words_of_classes_are_weak(page, want):
    assert html_text.main_text(page).split("\n\n") == want


def test_words_of_classes_still_count():
    few = "<p>" + LONG + "</p>"
    reader = "<article class=comment>" + few + "</article>"
    assert html_text.main_text("<article>" + few + "</article><div id=comments>" + reader * 9 + "</div>") == LONG
    assert html_text.main_text("<article>" + TEXT + "</article><div class=related><article>" + few + "</article></div>").split("\n\n") == PARTS
    assert html_text.main_text("<div>" + TEXT + "</div><div class=related><article>" + few + "</article></div>").split("\n\n") == PARTS
    assert html_text.main_text("<div class=social><article>" + few + "</article></div><p>A.</p><div id=comments>" + reader * 9 + "</div>") == LONG
    assert html_text.main_text("<div class=menu><a href=1>l1</a> <a href=2>l2</a></div>") == ""


QUOTES = [
    ("<article><p>First para.</p><p class=don't>Second para, here.</p><p>Third, it's here.</p></article>", ["First para.", "Second para, here.", "Third, it's here."]),
    ('<article><p>First para.</p><p title="a>Second para.</p><p>Third.</p></article>', ["First para.", "Second para.", "Third."]),
    ("<article><p title='a>b' lang = \"x>y\" 'odd' =>One.</p><p a=b/c d=>Two.</p><img alt=it's src=x>Three.</article>", ["One.", "Two.", "Three."]),
    ("<article><p title=\"one class='two\">One.</p><p title='say \"this'>Two.</p></article><div hidden><p>None.</p></div>", ["One.", "Two."]),
]


@pytest.mark.parametrize("page, want", QUOTES)
def test_quotes_count_behind_an_equals_sign_only(page, want):
    assert html_text.main_text(page).split("\n\n") == want


def test_deep_pages_cost_what_they_are_long():
    """Some 60,000 unclosed elements; climbing the tree for every block would take minutes and gigabytes."""
    import time

    begun = time.process_time()
    for opened in ("<div>", "<div class=menu>", "<p><span>", "<div class=widget><article>", "<ul><li>"):
        got = html_text.main_text("".join(f"{opened}Line {i}, here." for i in range(30_000)))
        assert got.startswith("Line 0, here.")
        assert "class" in opened or got.endswith("Line 29999, here.")
    assert time.process_time() - begun < 60


def labelled(n=900, seed=5):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = prose(rng, rng.randrange(15, 60)).split()
        bad = rng.random() < 0.2
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "zorbak", "zorbit", "you"]))
            words.insert(0, rng.choice(["zorbak", "moron"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = labelled()
    extra = [(5000, None), (5001, ""), (5002, "zorbak idiot you moron " * 5), (None, "you idiot"), rows[0]]
    table = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows + extra)
    got = toxicity.score_documents(docs, table).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    fresh = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in fresh]) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[5000].score == by_id[5001].score and by_id[5002].predicted == 1
    left = toxicity.keep_civil(docs, table)
    assert left.columns == docs.columns and 5002 not in {r.doc_id for r in left.collect()}
    constant = toxicity.score_documents(docs, table.where("toxic = 0")).collect()
    assert {r.score for r in constant} == {0.0}
    assert toxicity.score_documents(frame(spark, []), table).count() == 0


def test_features_of_insults():
    lexicon = toxicity.Lexicon(frozenset(["zorb"]), frozenset(["grum"]))
    plain = dict(zip(toxicity.FEATURES, toxicity.features("a calm line of words", lexicon)))
    loud = dict(zip(toxicity.FEATURES, toxicity.features("YOU 1d10t and i d i o t, grumly zorb!!", lexicon)))
    assert plain["insults"] == plain["learned"] == plain["hidden_insults"] == 0
    assert loud["learned_kinds"] > 0 and loud["hidden_insults"] > 0 and loud["proximity"] > 0 and loud["exclamation_rate"] > 0
    assert toxicity.features("", lexicon) == [0.0] * len(toxicity.FEATURES)


def test_language(spark):
    rng = random.Random(6)
    alphabets = {"aa": ["tha", "ing", "ou"], "bb": ["sch", "ung", "ei"], "cc": ["ción", "que", "ñ"]}

    def say(lang, n):
        return " ".join("".join(rng.choice(alphabets[lang]) for _ in range(2)) for _ in range(n))

    docs = spark.createDataFrame([(i, say(k, 40), k) for i, k in enumerate([*alphabets] * 40)], "doc_id long, text string, lang string")
    pages = []
    for i in range(90):
        lang = list(alphabets)[i % 3]
        pages.append((i, f"https://{lang}{i % 2}.example.{lang}/x", f"<html lang='{lang}'><p>{say(lang, 12 if i < 80 else 0)}</p></html>"))
    pages += [(200, None, None), (201, "no address", "<p>" + say("bb", 30)), (None, "https://aa1.example.aa/", "<html lang=xx><p>" + say("aa", 30))]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("own"))
    got = {r.page_id: r for r in language.identify(table, docs).collect()}
    assert len(got) == len(pages) and all(0 < r.probability <= 1 for r in got.values())
    # Pages without words are known by their host, suffix and declaration.
    assert all(got[i].lang == list(alphabets)[i % 3] for i in range(90))
    assert got[201].lang == "bb" and got[None].lang == "aa" and got[200].lang in alphabets
    assert language.identify(table, docs.limit(0)).count() == 0
    assert language.identify(table.limit(0), docs).count() == 0


def test_text_model_counts_all_texts(spark):
    # One text makes up a third of 30,000 rows, and one language has 3 of them.
    texts = [("AA", "the same text again" if i % 3 == 0 else f"thaing {'ouing' * (i % 7)} {'in' * (i % 11)}") for i in range(30_000)]
    texts += [("zz", "ción que ñ"), ("zz", "que que"), ("zz", "ñ ción"), ("yy", "1 2 3"), (None, "no language"), ("", "none"), ("aa", None)]
    made = language.fit_text(spark.createDataFrame(texts, "lang string, text string").repartition(4))
    assert made.languages == ("aa", "zz")
    for lang, logs in zip(made.languages, made.logs):
        counts = np.full(1 << language.BUCKET_BITS, language.SMOOTH)
        for own, text in texts:
            if own and text and own.lower() == lang:
                counts += np.bincount(language.trigrams(text), minlength=len(counts))
        assert np.allclose(logs, np.log(counts / counts.sum()))
    assert made.languages[int(made.scores("que ción").argmax())] == "zz"


@pytest.mark.parametrize("text, want", [("", 0), ("ab", 2), ("a b", 3)])
def test_trigrams(text, want):
    assert len(language.trigrams(text)) == want
