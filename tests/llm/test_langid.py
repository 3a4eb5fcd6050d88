import random
import zlib

from logtally.llm import langid
from tests.llm.helpers import by_id, frame

SYLLABLES = {"en": ["th", "er", "ing", "and", "ly"], "fr": ["eau", "oi", "ç", "ent", "lle"], "de": ["sch", "ung", "ü", "keit", "pf"]}


def corpus(n=150, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(30, 300))]
        rows.append((i, " ".join(words), lang, "s", 0))
    return rows


def test_held_out_accuracy_and_the_split(spark):
    rows = corpus()
    df = frame(spark, rows, extra=True)
    content = langid.fit(df.where(~langid.held_out()))
    assert sorted(content) == ["de", "en", "fr"]
    got = by_id(langid.identify(df, content).select("row.doc_id", "lang_pred", "lang_score").withColumn("held", langid.held_out()))
    assert {i: r["held"] for i, r in got.items()} == {r[0]: zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows}
    held = [r for r in rows if got[r[0]]["held"]]
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in held) >= 0.98 * len(held) > 30
    assert all(0 <= r["lang_score"] <= 1 for r in got.values())


def test_learns_from_the_given_rows_alone(spark):
    """Other labels outside the rows given, and other sources, change nothing."""
    rows = corpus(60)
    changed = [(i, t, "xx", "other", n) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, t, lang, s, n) for i, t, lang, s, n in rows]
    one, two = (langid.fit(frame(spark, r).where(~langid.held_out())) for r in (rows, changed))
    assert one == two


def test_odd_rows(spark):
    rows = corpus(60) + [(100, None, "en", None, 0), (101, "", None, None, 0), (102, "123 !?", "en", None, 0),
                         (103, "ing " * 5000, "en", None, 0), (None, "therand", None, None, 0)]
    df = frame(spark, rows)
    content = langid.fit(df)
    got = {r["row"]["doc_id"]: r for r in langid.identify(df, content).collect()}
    for i in (100, 101, 102):
        assert (got[i]["lang_pred"], got[i]["lang_score"], got[i]["lang_rejected"]) == ("und", 0.0, True)
    assert got[103]["lang_pred"] == "en"
    assert {r["lang_pred"] for r in langid.identify(df, {}).collect()} == {"und"}
    assert langid.fit(df.limit(0)) == {} and langid.identify(df.limit(0), content).collect() == []
    kept = langid.keep_identified(df, df)
    assert kept.columns == df.columns and not {r["doc_id"] for r in kept.collect()} & {100, 101, 102}


def test_ties_go_to_the_more_frequent_language():
    model = langid.Classifier({"zz": b"same words here", "aa": b"same words here"})
    assert model.predict("same words")[::2] == ("zz", True)


def test_every_label_is_learned_and_the_sample_stays_bounded(spark, monkeypatch):
    """90 languages, the last of them rare, each with syllables of its own."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(90):
        own = ["".join(rng.choices(letters, k=3)) for _ in range(6)]
        for _ in range(12 if k < 70 else 8):
            rows.append((len(rows), " ".join("".join(rng.choices(own, k=3)) for _ in range(80)), f"l{k}", "s", 0))
    df = frame(spark, rows)
    content = langid.fit(df.where(~langid.held_out()))
    assert len(content) == 90
    got = {r["row"]["doc_id"]: r for r in langid.identify(df, content).collect()}
    assert all(got[i]["lang_pred"] == lang and not got[i]["lang_rejected"] for i, _, lang, _, _ in rows)
    # the budget of two full samples of three documents, shared by 90
    seen = []
    monkeypatch.setattr(langid, "FULL_SAMPLES", 2)
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 3)
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 600)
    monkeypatch.setattr(langid, "dictionaries", lambda samples: seen.append(samples) or {})
    langid.fit(df)
    assert len(seen[0]) == 90 and all(len(t) == 1 and len(t[0]) == 40 for t in seen[0].values())
    for n in (0, 1, 64, 65, 1000, 16384, 10**6):
        docs, chars = langid.shares(n)
        assert docs >= 1 and chars >= 1 and n * docs * chars <= max(n, 2 * 3 * 600)
