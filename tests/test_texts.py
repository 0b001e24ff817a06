import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.functions import chunking, cleaning, entity_batches, extraction, fixed_values
from tidemill.functions.batches import text_slices
from tidemill.functions.cleaning import CleaningOptions
from tidemill.operators import reports
from tidemill.plans.jobs import clean_corpus

DIRTY = """
   <div>The  ferry\tleaves   at  noon.  </div>
   \n   \n   \n   Timetable: http://ferry.example/t, questions to desk@ferry.example

      Cookie policy in the cabin.

   A “return” ticket—two stamps.

   Bring  cash.

   Bring  cash.
   """
CLEAN = (
    "The ferry leaves at noon. \n\nTimetable: http://ferry.example/t, questions to [EMAIL]\n\n"
    'Cookie policy in the cabin.\n\nA "return" ticket—two stamps.\n\nBring cash.'
)
NOTES = """
   Harbour log - March 3, 2024

   Crew: Nora Hale
   Berth: North quay
   Inspection = 2024-03-18
   - Pilot: pilot@harbour.example, (212) 555-0148
   - Agent: agent.two@cargo.example, +1-646-555-0171
   - Dues: $12,400.50
   - Fuel: €9,300
   - Ropes: £810.00
   - Chart: https://charts.example/n/7
   Closed: 3 Apr 2024
   """


def test_dirty_text(spark):
    df = spark.createDataFrame([(1, DIRTY)], "doc_id long, text string")
    assert clean_corpus(df).first()["text"] == CLEAN
    report = reports.reduction(df, F.col("text"), F.lit(CLEAN)).first()
    assert (report["chars_before"], report["chars_after"]) == (len(DIRTY), len(CLEAN))


def test_cleaning_switches(apply):
    text = " <b>a</b>  “q” x@y.zz https://u.v/w \x07 "
    off = CleaningOptions(False, False, False, False, False, False)
    assert apply(lambda c: cleaning.clean_text(c, off), text) == [text.strip()]
    on = CleaningOptions(remove_urls=True)
    assert apply(lambda c: cleaning.clean_text(c, on), text) == ['a "q" [EMAIL] [URL]']
    assert apply(cleaning.clean_text, None) == [None]


def test_emails_are_masked_as_whole_runs(apply):
    texts = ["(a@b.c), d", "@b.c", "a@b.", "x" * 5000 + " <m@n.o>", "a@b a.b@c.d.e;"]
    assert apply(cleaning.mask_emails, *texts) == ["[EMAIL] d", "@b.c", "a@b.", "x" * 5000 + " [EMAIL]", "a@b [EMAIL]"]


def test_markdown(apply):
    cases = {
        "Skip to content\nx": "x",
        "Jump to\nTable of Contents\nSkip to main content": "",
        "skip to content": "skip to content",
        "a\nWE USE cookies\r and more\nb": "a\nb",
        "a\nwe use cookies": "a\nwe use cookies",
        "a =====----- b ---- c": "a --- b ---- c",
        "x\n#\n\nfoo": "x\n\nfoo",
        "text\n\n\n\n## h": "text\n\n## h",
        "####### seven": "####### seven",
    }
    assert apply(cleaning.clean_markdown, *cases) == list(cases.values())


def test_paragraphs(apply):
    cases = {"A\n\n a \n\nB\n\n\n\nb": "A\n\nB", "": "", "\n\n \n\n": "", " x\n\nY": " x\n\nY", "a\n\n\nA": "a"}
    assert apply(cleaning.deduplicate_paragraphs, *cases) == list(cases.values())
    rng = random.Random(3)
    texts = ["\n\n".join(rng.choice(["a", "B ", "b", " c", "", "D d"]) for _ in range(60)) for _ in range(30)]
    want = []
    for text in texts:
        first = {}
        for p in text.split("\n\n"):
            first.setdefault(p.strip().lower(), p)
        want.append("\n\n".join(p for key, p in first.items() if key))
    once = apply(cleaning.deduplicate_paragraphs, *texts)
    assert once == want
    assert apply(cleaning.deduplicate_paragraphs, *once) == once


def test_harbour_log(spark):
    df = spark.createDataFrame([(1, NOTES)], "doc_id long, text string")
    df = df.select("doc_id", extraction.extract_all(F.col("text")).alias("record"))
    r = df.first()["record"]
    assert r["emails"] == ["agent.two@cargo.example", "pilot@harbour.example"]
    assert set(r["phones"]) == {" (212) 555-0148", "+1-646-555-0171"}
    assert set(r["urls"]) == {"https://charts.example/n/7"}
    assert set(r["dates"]) == {"March 3, 2024", "2024-03-18", "3 Apr 2024"}
    assert [tuple(m) for m in r["monetary"]] == [("$12,400.50", 12400.5, "USD"), ("€9,300", 9300.0, "EUR"), ("£810.00", 810.0, "GBP")]
    pairs = r["key_value_pairs"]
    assert pairs["- Agent"] == "agent.two@cargo.example, +1-646-555-0171" and pairs["Inspection"] == "2024-03-18"
    total = 2 + 2 + 1 + 3 + 3 + len(pairs)
    assert len(pairs) == 11
    assert tuple(reports.entity_totals(df).first()) == (1, total)
    assert {x["kind"]: x["n"] for x in reports.entity_counts(df).collect()}["pair"] == len(pairs)
    assert reports.entity_rows(df).count() == total


def _flat(r):
    names = ["emails", "phones", "urls", "dates", "monetary"]
    return F.to_json(F.struct(*[r[n].alias(n) for n in names], F.map_entries(r["key_value_pairs"]).alias("pairs")))


def test_batches_and_columns_give_the_same_records(apply, monkeypatch):
    """Texts of all kinds side by side in one slice, some with letters, digits and blanks beyond ASCII."""
    parts = [
        "a@b.co", "1@c.de", "@", ".com", "+1", "(415)", " 555-0100", "1234", "12", "-", "/", "2024-01-02", "1/2/24", "Jan", "SEP", "5 Mar 2024",
        "mayApr 5, 2024", " ", "\n", "\t", "\x1f", ",", "$", "€1,234.56", "£,", "USD", " EUR", "3.1415 USD", ".50", ":", "=", "k: v", "–", "“x”", "_", "x" * 60,
        "https://ex.org/a?b=%20", "é", "ſ", "٣", "\xa0", "\u2028", "😀", "\x00",
    ]
    rng = random.Random(4)
    texts = ["".join(rng.choice(parts[: rng.choice([37, 37, len(parts)])]) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["", None, "\n", "5 Mar 2024 Apr 2025", "Jan 5, 2024Feb 5, 2024", "a" * 3000 + "@" * 50, "1" * 400 + " USD", "k=\nk: 2\n k :3"]
    want = apply(lambda c: _flat(extraction._record(c)), *texts)
    assert apply(lambda c: _flat(extraction.extract_all(c)), *texts) == want
    plain = [t for t in texts if t is not None and all(ord(x) < 128 or x in "€£–“”😀" for x in t)]
    assert len(plain) > 1500
    got = entity_batches.records(pa.array([*plain, None]))
    assert len(got) == len(plain) + 1 and got[len(plain)].as_py() == {n: [] for n in got.type.names}
    assert len(entity_batches.records(pa.array([], pa.string()))) == 0


def test_most_texts_are_searched_in_batches(apply):
    """Signs beyond ASCII that no class holds do not send a text to the columns, letters do."""
    seen = apply(lambda c: ~F.rlike(c, F.lit(fixed_values.CLASSED_BEYOND_ASCII)), "plain", "€ £ – “x” … 😀", "é", "\xa0", "٣")
    assert seen == [True, True, False, False, False]


def test_money(apply):
    got = apply(extraction.extract_money, "$100 USD", "$,", "1,000 INR", "€5.50 €5.50", "12.345 EUR", None)
    as_tuples = [None if g is None else [tuple(m) for m in g] for g in got]
    assert as_tuples == [
        [("$100", 100.0, "USD"), ("100 USD", 100.0, "USD")], [], [("1,000 INR", 1000.0, "INR")],
        [("€5.50", 5.5, "EUR")] * 2, [("345 EUR", 345.0, "EUR")], None,
    ]


def test_names(apply):
    texts = ["John Smith said. Mary Ann Jones left", "New York City is big.", "Single", "the John Smith"]
    assert apply(extraction.extract_names, *texts) == [["John Smith", "Mary Ann Jones"], [], [], []]


def test_pairs(apply):
    text = "a: 1\nb = 2\nc - 3\nhttps://x.y\n a : 9 \n" + "k" * 60 + ": v\nk:\n: lead: x\nq=r: s"
    got = apply(extraction.extract_pairs, text)[0]
    assert got == {"a": "9", "b": "2", "c": "3", "https": "//x.y", ": lead": "x", "q=r": "s"}


def test_emails_after_a_match_inside_a_run(apply):
    assert apply(extraction.extract_emails, "a@b.co1@c.de x@y.zz") == [["1@c.de", "a@b.co", "x@y.zz"]]


def test_long_texts_stay_linear_and_shallow(apply):
    texts = ["a" * 200_000, "1," * 100_000, "Title Case " * 50_000, "https://" + "a." * 100_000, "(" * 100_000, "- " * 100_000]
    for function in (extraction.extract_all, extraction.extract_names, cleaning.clean_markdown):
        assert len(apply(lambda c: function(c).cast("string"), *texts)) == len(texts)


def test_word_chunks(apply):
    def brute(text, size, overlap):
        words = text.split()
        return [" ".join(words[i : i + size]) for i in range(0, len(words), size - overlap)]

    texts = [" ".join(map(str, range(n))) for n in (0, 1, 3, 4, 5, 10, 11)] + [" a b\tc\n\nd "]
    for size, overlap in ((5, 2), (5, 0), (1, 0), (1000, 200)):
        got = apply(lambda c: chunking.chunk_words(c, size, overlap), *texts)
        assert got == [brute(t, size, overlap) for t in texts]
    for bad in (5, 6, -1):
        with pytest.raises(ValueError):
            chunking.chunk_words(F.col("x"), 5, bad)


def test_character_chunks():
    split = chunking.split_characters
    assert split("", 10, 2) == [] and split(" \n\n ", 10, 2) == []
    assert split("one two", 100, 20) == ["one two"]
    assert split("aaa bbb ccc ddd", 8, 4) == ["aaa bbb", "bbb ccc", "ccc ddd"]
    assert split("para one\n\npara two", 10, 0) == ["para one", "para two"]
    assert split("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("ab  .\n") for _ in range(rng.randrange(300)))
        size = rng.randrange(2, 40)
        overlap = rng.randrange(0, size)
        chunks = split(text, size, overlap)
        assert all(0 < len(c) <= size for c in chunks)
        squeezed, at = text, 0
        for c in chunks:  # every chunk stands in the text, at or after the start of the one before
            at = squeezed.index(c, at)
        assert set("".join(chunks)) >= set(text) - set(" \n")


def test_character_chunks_in_spark(apply):
    texts = ["First line. Second one.\n\nAnother paragraph", None, ""]
    got = apply(lambda c: chunking.chunk_characters(c, 20, 5), *texts)
    assert got == [chunking.split_characters(texts[0], 20, 5), None, []]


def test_text_slices_are_bounded_and_whole():
    texts = pa.array(["é" * 300, None, "", "b" * 5000] * 500)
    slices = list(text_slices(texts.slice(1), most=20_000))
    assert [t for s in slices for t in s.to_pylist()] == texts.to_pylist()[1:]
    assert max(sum(len((t or "").encode()) for t in s.to_pylist()) for s in slices) <= 20_000 + 5000
    assert [len(s) for s in text_slices(pa.array([], pa.string()))] == [0]


def test_texts_of_a_batch_are_read_in_slices(spark, monkeypatch):
    """A batch of many long texts never becomes Python strings at once."""
    from tidemill.functions import chunking, embedding, html

    rows = [(i, f"<p>{i} " + "word " * 3000 + "</p>") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    for function in (chunking.chunk_characters, embedding.hashing_embedding, html.html_blocks):
        found = function(F.col("text"))
        assert df.select("id", found.alias("r")).where(F.size("r") > 0).count() == 300
    for module in (chunking, embedding, html):
        assert module.text_slices is text_slices
