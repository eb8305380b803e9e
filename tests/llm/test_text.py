"""URL filter, chat formatting, personal data, language, decontamination, packing and LM scores."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from postmill.llm import chat_format, decontaminate, language_id, lm_score, packing, pii, url_filter
from tests.llm.helpers import empty, prose, rows, table, words

# --- URL filter -------------------------------------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b.c", "/x/pa", "block"), ("a.b.c", "/x/pa", "allow"), ("", "/", "block"), (None, "/", "block"), ("net", "/", "maybe")]
URLS = [None, "", "no scheme", "http://", "http://net", "http://net/", "https://X.Example.NET/en/1", "http://example.net/EN/",
        "ftp://notexample.net/en/", "http://example.com/de/?q=/en/", "http://example.com/de", "http://example.com?/de/",
        "http://www.a.b.c/x/path#/", "http://a.b.c/x/p", "http://org/fr/a://b", "x://y://org/fr/", "http://a..net//x",
        "http://" + "s." * 3000 + "net/" + "p/" * 3000, "http://org:80/fr/", "http://net/", "http:///fr/"]


def judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in RULES if h is not None and v != "maybe"
           and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_urls_equal_brute_force(spark):
    data = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, "http://net/a", "h"), (3, "http://net/a", "h"), (3, "http://net/a", "h")]
    pages = spark.createDataFrame(data, "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, url_filter.RULES_SCHEMA)
    got = Counter(tuple(r) for r in url_filter.filter_urls(pages, rules).collect())
    assert got == Counter((i, *judge(u)) for i, u, _ in data)


def test_urls_without_rules_or_pages(spark):
    none = spark.createDataFrame([], url_filter.RULES_SCHEMA)
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.filter_urls(pages, none, default="block").collect()] == [(1, "a", "/b", None, "block")]
    rules = spark.createDataFrame(RULES, url_filter.RULES_SCHEMA)
    assert url_filter.filter_urls(pages.where("false"), rules).count() == 0


# --- Chat formatting --------------------------------------------------------------------------------------------

PIECES = ["</s>", "[INST]", "[/INST]", "<s>", "[ROLE:", "[/ROLE]", "[ROLE:x]", "\\", "\\1", "~", " ", "<", "]", "\n", "é😀", "word"]


def test_chat_round_trip(spark):
    rng = random.Random(5)
    data = [(c, t, rng.choice(["user", "assistant", "system", "", None, "a]b", "[ROLE:", "user "]),
             None if rng.random() < 0.05 else "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))), "x")
            for c in [*range(30), None] for t in [*range(5), 3, None]]
    data += [(99, 1, "user", "long [INST] " * 5000, "x")] + [(98, 0, "assistant", "same", "x")] * 3
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    for c in {d[0] for d in data}:
        key = lambda d: (d[1] is not None, d[1] or 0, d[2] or "", d[3] or "")
        turns = [(d[2] or "", d[3] or "") for d in sorted((d for d in data if d[0] == c), key=key)]
        assert [tuple(t) for t in got[c].turns] == turns and got[c].identical
    assert chat_format.format_conversations(df.where("false")).count() == 0


def test_chat_escapes_only_conflicts(spark):
    df = spark.createDataFrame([(1, 0, "user", "a <b> [c] \\"), (1, 1, "assistant", "x</s>"), (1, 2, "system", "s")],
                               "conv_id long, turn long, role string, text string")
    r = chat_format.format_conversations(df).first()
    assert r.formatted == "[INST] a <b> [c] \\[/INST]<s>~x\\1/s></s>[ROLE:system] s[/ROLE]"


# --- Personal data ----------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                  or kind == "card" and 13 <= len(d) <= 19 and sum(
                      sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
                  or kind == "phone" and 9 <= len(d) <= 15)
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    bits = ["a", "Zb9", "@", ".", "-", "+", "_%", " ", "@x.y", "me@ex.org", "1.2.3.4", "300.1.1.1", "0012.1.255.0", "12", "7", "()", "\n",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234567", "+1", "é", "٣", "5500005555555559"]
    for _ in range(4000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert [s[:3] for s in pii.base_spans(t)] == plain_spans(t), t
    assert [s[:3] for s in pii.base_spans("1" * 50_000 + "@" * 1000)] == []


def test_disclosing_terms(spark):
    """``zorbane`` stands only with the address, ``common`` everywhere; one document alone proves nothing."""
    data = [(i, f"common filler{'abcdefghij'[i % 10]} words here") for i in range(60)]
    data += [(100 + i, "common zorbane wrote from me@ex.org about Unique" + "abc"[i] * 3) for i in range(3)]
    data += [(200, "common zorbane alone"), (201, None), (202, ""), (None, "me@ex.org")]
    got = {r.doc_id: r for r in pii.find(table(spark, data)).collect()}
    assert len(got) == len(data)
    r = got[100]
    spans = {data[60][1][x.s:x.e]: x.kind for x in r.more}
    assert [tuple(x) for x in r.base] == [("email", 26, 35)] and got[200].more == [] and got[201].base == []
    n, n_e = len(data), 4
    want = math.log(n * 3 / (4 * n_e)) / math.log(n / n_e)
    assert ("zorbane" in spans) == (want >= pii.GENERALISE_AT)
    assert spans["wrote"] == "remove" and "common" not in spans and "Uniqueaaa" not in spans
    assert pii.find(empty(spark)).count() == 0


def links_brute_force(data):
    """(id, start, end, kind) of every term to hide, counted over whole documents."""
    parts = []
    for _, t in data:
        base = plain_spans(t or "")
        ent = {(k, (t[a:b].lower() if k == "email" else t[a:b])) for k, a, b in base}
        terms = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{3,}", t or "")]
        parts.append((ent, {x for x, _, _ in terms}, [x for x in terms if all(x[2] <= a or b <= x[1] for _, a, b in base)]))
    n, n_t, n_e, n_te = len(data), Counter(), Counter(), Counter()
    for ent, terms, free in parts:
        n_t.update(terms)
        n_e.update(ent)
        n_te.update((e, t) for e in ent for t in {x for x, _, _ in free})
    ratio = {(e, t): math.log(n * c / (n_t[t] * n_e[e])) / math.log(n / n_e[e]) for (e, t), c in n_te.items() if c >= 2 and n_e[e] < n}
    out = Counter()
    for (i, _), (ent, _, free) in zip(data, parts):
        for t, a, b in free:
            r = max((ratio.get((e, t), -9.0) for e in ent), default=-9.0)
            if r >= 0.9:
                out[i, a, b, "remove" if r >= 0.98 else "generalise"] += 1
    return out


def test_disclosing_terms_anywhere_in_the_document(spark):
    """A name far from the address, and standing again after it; several entities in a document; equal to brute force."""
    rng = random.Random(6)
    data = [(i, prose(rng, 30)) for i in range(80)]
    data += [(100 + i, "Zorbane wrote " + prose(rng, 25) + " me@ex.org " + prose(rng, 40) + " zorbane, Wukasi") for i in range(3)]
    data += [(200 + i, "near one@ex.org and 1.2.3.4 " + prose(rng, 12) + " farword" + " quelle" * (i % 2)) for i in range(5)]
    data += [(300, "farword " + prose(rng, 9)), (301, None), (302, ""), (303, "quelle me@ex.org")]
    got = Counter()
    for r in pii.find(table(spark, data)).collect():
        got.update((r.doc_id, x.s, x.e, x.kind) for x in r.more)
    assert got == links_brute_force(data)
    text = data[80][1]
    hidden = [text[a:b] for i, a, b, _ in got if i == 100]
    assert hidden.count("Zorbane") == hidden.count("zorbane") == hidden.count("Wukasi") == 1


def test_sanitise(spark):
    data = [(100 + i, "note: zorbane of me@ex.org is Wukasi") for i in range(3)] + [(i, "plain words") for i in range(50)] + [(7, None)]
    out = pii.sanitise(table(spark, data))
    assert out.columns == table(spark, []).columns and out.count() == len(data)
    texts = Counter(r.text for r in out.collect())
    assert texts["plain words"] == 50 and texts[None] == 1 and texts[": of <EMAIL> is "] + texts[":  of <EMAIL> is "] == 3


# --- Language ---------------------------------------------------------------------------------------------------


def languages(n=240, seed=2):
    rng = random.Random(seed)
    syllables = {"xx": ["ka", "ko", "ri", "ta"], "yy": ["sch", "ung", "ein", "er"], "zz": ["ção", "lho", "nh", "os"]}
    out = []
    for i in range(n):
        lang = rng.choice(list(syllables))
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(rng.randint(3, 40)))
        out.append((i, text, lang, "l", "s", 1))
    return out


def test_language_held_out_accuracy(spark):
    extra = [(1001, None, "xx", "l", "s", 1), (1002, "", "xx", "l", "s", 1), (1003, "12 !? ²", "yy", "l", "s", 1),
             (1004, "kakori " * 300_000, None, "l", "s", 1), (None, "schungein er", None, "l", "s", 1)]
    docs = spark.createDataFrame(languages() + extra, "doc_id long, text string, lang string, lang_x string, score_x string, row int")
    model = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.predict(docs, model).withColumn("h", language_id.held_out("doc_id", 3)).collect()}
    held = [r for r in got.values() if r.doc_id is not None and r.doc_id < 1000 and r.h]
    assert len(held) > 40 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(r.h == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values() if r.doc_id is not None)
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in (1001, 1002, 1003)] == [("und", 0.0, True)] * 3
    assert got[1004].lang_pred == "xx" and got[None].lang_pred == "yy" and not got[None].h
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sum(r.rejected for r in held) <= 0.05 * len(held)


UNLEARNED = ["это предложение на русском языке которого модель не видела", "zxqv kjwq xzzq vvkq " * 8, "qwrtp zxcvb ghjkl mnbvc qwrtp " * 5]


def test_language_rejects_what_was_not_learned(spark):
    """The threshold comes from the calibration texts: another language and gibberish below it go, clean short rows stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    assert all(model.predict(t)[1] < model.threshold for t in UNLEARNED)
    assert all(model.predict(t)[1] > 0.35 for t in UNLEARNED)
    held = [r.text.split() for r in docs.where(language_id.held_out("doc_id", 3)).collect()]
    short = [" ".join(w[len(w) // 2:len(w) // 2 + 6]) for w in held if len(w) > 12]
    mixed = [a + " " + b for a, b in zip(short, short[1:])]
    for texts in (short, mixed):
        assert sum(model.predict(t)[1] >= model.threshold for t in texts) >= 0.97 * len(texts) > 200


def test_language_without_training(spark):
    e = empty(spark)
    assert language_id.fit(e) is None and language_id.predict(e, None).count() == 0
    unlabelled = table(spark, [(1, "words")])
    r = language_id.predict(unlabelled, language_id.fit(unlabelled)).first()
    assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)


def test_language_pieces_lose_no_subword(monkeypatch):
    t = "Straße und ção " * 50
    whole = language_id.counts(t)
    monkeypatch.setattr(language_id, "PIECE", 37)
    assert (language_id.counts(t) == whole).all()


def plain_buckets(text):
    """Every subword of two to four bytes, one at a time: A-Z folded, other ASCII a blank, ending in two blanks left out."""
    b = [c if c > 127 else c | 32 if chr(c).isalpha() else 32 for c in text.encode()]
    out = Counter()
    for n in (2, 3, 4):
        for i in range(len(b) - n + 1):
            gram = b[i:i + n]
            if gram[-2:] != [32, 32]:
                out[((int.from_bytes(bytes(gram)) ^ (n * 0x5BD1E995 & 0xFFFFFFFF)) * 0x9E3779B1 & 0xFFFFFFFF) >> 18] += 1
    return out


def plain_probabilities(z):
    e = [math.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def test_language_predictions_against_plain_computation(spark):
    docs = spark.createDataFrame([r[:3] for r in languages(120)] + [(900, "Çà et  là, ÉTÉ 42!", "xx"), (901, "a", "yy"), (902, "word " * 700, None)],
                                 "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    for r in language_id.predict(docs, model).collect():
        n = plain_buckets(r.text)
        z = [sum(c * float(model.scores[k, y]) for k, c in n.items()) / max(sum(n.values()), 1) / model.temperature for y in range(len(model.labels))]
        p = plain_probabilities(z)
        assert r.score == pytest.approx(max(p), abs=1e-5) and p[model.labels.index(r.lang_pred)] == pytest.approx(max(p), abs=1e-5)
        assert r.rejected == (r.score < model.threshold)


def test_language_training_against_plain_gradient(monkeypatch):
    """The same steps with dense vectors: embedding mean, output layer, softmax, gradient; then the temperature by its loss."""
    monkeypatch.setattr(language_id, "EPOCHS", 3)
    data = [(r[2], r[1]) for r in languages(60)]
    rows = []
    for y, t in data:
        n = sorted(plain_buckets(t).items())
        rows.append((y, np.array([k for k, _ in n]), np.array([c for _, c in n], float), []))
    model = language_id.train(rows)
    labels = sorted({y for y, _ in data})
    rng = np.random.default_rng(7)
    emb, out = rng.uniform(-1 / language_id.DIM, 1 / language_id.DIM, (language_id.BUCKETS, language_id.DIM)), np.zeros((language_id.DIM, len(labels)))
    dense = []
    for y, idx, c, _ in rows:
        x = np.zeros(language_id.BUCKETS)
        x[idx] = c / c.sum()
        dense.append((labels.index(y), x))
    fit, held = [d for i, d in enumerate(dense) if i % 5], dense[::5]
    for epoch in range(3):
        for i in rng.permutation(len(fit)):
            y, x = fit[i]
            error = np.array(plain_probabilities((x @ emb) @ out)) - np.eye(len(labels))[y]
            step = language_id.RATE * (1 - epoch / 3)
            to_emb, to_out = np.outer(x, out @ error), np.outer(x @ emb, error)
            emb, out = emb - step * to_emb, out - step * to_out
    assert model.labels == labels and np.abs(model.scores - emb @ out).max() < 1e-4

    def loss(t):
        return -sum(math.log(plain_probabilities((x @ emb) @ out / t)[y] + 1e-12) for y, x in held)

    assert loss(model.temperature) <= min(loss(t) for t in np.geomspace(0.05, 20, 60)) + 1e-4


# --- Decontamination --------------------------------------------------------------------------------------------


def shingles(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def leaks(docs, items):
    out = Counter()
    for i, t in docs:
        s = shingles(t)
        for k, x in set(items):
            item = shingles(x)
            if not s or not item:
                continue
            n, best = len(item), 0.0
            for a in range(max(1, len(s) - n + 1)):
                window = Counter(s[a:a + n])
                both = sum((window & Counter(item)).values())
                best = max(best, both / (sum(window.values()) + n - both))
            if best >= 0.8:
                out[(i, k, round(best, 9))] += 1
    return out


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_contaminated_equals_brute_force(spark, monkeypatch, limit):
    """With the benchmark's shingles broadcast, and shuffled."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    rng = random.Random(9)
    items = [(k, prose(rng, rng.randint(30, 50))) for k in range(8)] + [(50, None), (51, ""), (52, "only four words here"), (53, "ba ba " * 20), (None, "a null item of six words")]
    items += [items[0], (60, items[1][1])]
    docs = [d for d in rows() if not d[1] or len(d[1]) < 50_000]
    for k, (_, t) in enumerate(items[:8]):
        w = t.split()
        docs += [(300 + k, prose(rng, 50) + " " + t.upper() + ", " + prose(rng, 20)), (320 + k, " ".join(w[2:]) + " " + prose(rng, 10)),
                 (340 + k, " ".join(w[:20] + ["edit"] + w[21:])), (360 + k, " ".join(["edit"] + w[1:])), (380 + k, " ".join(w[:10]))]
    docs += [(400, "ba ba " * 20), (401, "Only: four words here!"), (402, "ba " * 300), (None, items[2][1]), (403, items[3][1]), (403, items[3][1]), (404, "a null item, of six words")]
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, n int")
    got = decontaminate.contaminated(table(spark, docs), bench).collect()
    assert Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got) == leaks(docs, items)
    clean = decontaminate.keep_clean(table(spark, docs), bench)
    bad = {i for i, _, _ in leaks(docs, items)}
    gone = {(i, t) for i, t in docs if leaks([(i, t)], items)}
    assert bad and Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(d for d in docs if d not in gone)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_reordered_copies_equal_brute_force(spark, monkeypatch, limit):
    """Copies whose halves or sentences change places, alone and inside longer documents."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    rng = random.Random(11)
    items = [(k, prose(rng, 60 + 20 * k)) for k in range(5)]
    docs = []
    for k, (_, t) in enumerate(items):
        w = t.split()
        half, third = len(w) // 2, len(w) // 3
        for j, x in enumerate((w[half:] + w[:half], w[2 * third:] + w[third:2 * third] + w[:third], w[5:] + w[:5])):
            docs += [(10 * k + j, " ".join(x)), (100 + 10 * k + j, prose(rng, 100) + " " + " ".join(x) + " " + prose(rng, 100))]
    docs += [docs[1], docs[1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(table(spark, docs), bench).collect()
    assert Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got) == leaks(docs, items)
    assert any(100 <= r.doc_id and r.doc_id % 10 == 0 for r in got)


def test_repeated_words_equal_brute_force(spark):
    """Items copied but for a run of one filler word, whose shingles repeat in the window or in the item."""
    rng = random.Random(12)
    items, docs = [], []
    for k in range(12):
        w = prose(rng, 208 if k < 8 else 458).split()
        n = 16 + k % 4 if k < 8 else 30
        filled = w[:-n] + ["filler"] * n
        copy, item = (filled, w) if k % 2 else (w, filled)
        items.append((k, " ".join(item)))
        docs += [(k, prose(rng, 40) + " " + " ".join(copy) + " " + prose(rng, 40))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = leaks(docs, items)
    got = decontaminate.contaminated(table(spark, docs), bench).collect()
    assert len(want) == 12 and Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got) == want


def test_no_short_match_is_lost(spark):
    """Thousands of copies just at the similarity, of short items: the radius grows as items get shorter."""
    rng = random.Random(13)
    items, docs = [], []
    for k in range(3000):
        w = [f"w{rng.randrange(10 ** 9)}" for _ in range((9, 9, 14, 19)[k % 4])]
        items.append((k, " ".join(w)))
        # The copy lacks as many words at the end as similarity 0.8 allows.
        n = len(w) - 4
        docs.append((k, " ".join(w[:len(w) - (n - math.ceil(0.8 * n - 1e-9))])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert got.where("doc_id = item_id").count() == 3000


def test_radius_bounds_the_loss():
    rng = np.random.default_rng(14)
    for n in (2, 5, 9, 15, 60, 300):
        shared = math.ceil(0.8 * n - 1e-9) if n > 4 else n
        h = rng.integers(0, 2, (4000, n, decontaminate.BITS))
        a, b = h.sum(1) * 2 > n, h[:, :shared].sum(1) * 2 > shared
        far = (a != b).sum(1)
        assert abs(far.mean() - 64 * decontaminate.bit_difference(shared, 0, n - shared)) < 0.4
        assert far.max() <= decontaminate.radius(n)
    assert decontaminate.radius(5) > decontaminate.radius(60) >= decontaminate.radius(512) > 15


def test_very_long_documents_and_items_are_searched_whole(spark):
    rng = random.Random(15)
    item, long = prose(rng, 3000), prose(rng, 15_000)
    docs = [(1, long + " " + item + " " + prose(rng, 4000)), (2, long), (3, item)]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.similarity, r.window_start) for r in got) == [(1, 7, 1.0, 15_000), (3, 7, 1.0, 0)]


def test_fingerprint_numbers_repeats(spark):
    rng = np.random.default_rng(5)
    h = [rng.choice(rng.integers(-2 ** 63, 2 ** 63, 6), 20).tolist() for _ in range(10)]
    df = spark.createDataFrame([(x,) for x in h], "h array<bigint>").select("h", decontaminate.numbered(F.col("h")).alias("s"))
    pairs = {}
    for r in df.collect():
        want = sorted((x, sum(y == x for y in r.h[:i + 1])) for i, x in enumerate(r.h))
        assert len(set(r.s)) == 20
        for x, y in zip(want, r.s):
            assert pairs.setdefault(x, y) == y


def test_simhash_expression(spark):
    rng = np.random.default_rng(4)
    h = rng.integers(-2 ** 63, 2 ** 63, (20, 7)).tolist()
    got = [r.f for r in spark.createDataFrame([(x,) for x in h], "h array<bigint>").select(decontaminate.simhash(F.col("h")).alias("f")).collect()]
    want = [sum(1 << b for b in range(64) if 2 * sum((v >> b) & 1 for v in x) > len(x)) for x in h]
    assert [g % 2 ** 64 for g in got] == want


def test_decontamination_empty(spark):
    bench = spark.createDataFrame([(1, "some item text of several words")], "item_id long, text string")
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    docs = table(spark, rows()[:5])
    assert decontaminate.keep_clean(docs, bench.where("false")).count() == 5


# --- Packing ----------------------------------------------------------------------------------------------------


def test_packing_is_best_fit():
    rng = random.Random(8)
    lengths = sorted((rng.randint(1, 4096) for _ in range(3000)), reverse=True)
    bins, offsets, caps = packing.pack(lengths)
    free, opened = [], []
    for n, b in zip(lengths, bins):
        fits = [(f, k) for k, f in enumerate(free) if f >= n]
        if fits:
            assert b == min(fits)[1]
            free[b] -= n
        else:
            assert b == len(free)
            opened.append(n)
            free.append(None)
            # The opened size is found again from the offsets below; here only that it holds the piece.
            used = [x for x, y in zip(lengths, bins) if y == b]
            free[b] = min(c for c in packing.CAPACITIES if c >= max(sum(used), n)) - n if sum(used) <= n else None
            free[b] = _opened_size(lengths, len(opened), n, bins, b) - n
    for b, c in enumerate(caps):
        total = sum(n for n, y in zip(lengths, bins) if y == b)
        assert c == min(x for x in packing.CAPACITIES if x >= total)


def _opened_size(lengths, _, n, bins, b):
    at = bins.index(b)
    rest = sum(lengths[at + 1:])
    return min((c for c in packing.CAPACITIES if c >= n), key=lambda c: (packing.cost(c) / (n + min(c - n, rest)), c))


def test_packing_keeps_every_token(spark):
    data = rows()
    out = packing.pack_documents(table(spark, data), shard_pieces=20).collect()
    got = Counter()
    for r in out:
        got[r.doc_id, r.row] += r.n_tokens
    by_id = {}
    for i, t in data:
        by_id.setdefault(i, Counter())[len(words(t)) + 1] += 1
    assert {i: Counter(n for (j, _), n in got.items() if j == i) for i in by_id} != {}
    assert sum(r.n_tokens for r in out) == sum(len(words(t)) + 1 for _, t in data)
    bins = {}
    for r in sorted(out, key=lambda r: (r.bin_id, r.bin_offset)):
        at, cap = bins.get(r.bin_id, (0, r.capacity))
        assert r.bin_offset == at and r.capacity == cap and r.n_tokens <= max(packing.CAPACITIES)
        bins[r.bin_id] = (at + r.n_tokens, cap)
    assert all(c == min(x for x in packing.CAPACITIES if x >= n) for n, c in bins.values())
    pieces = sorted((r.piece, r.start, r.n_tokens) for r in out if r.doc_id == 140)
    assert [s for _, s, _ in pieces] == [sum(n for _, _, n in pieces[:k]) for k in range(len(pieces))]
    assert packing.pack_documents(empty(spark)).count() == 0


# --- LM scoring -------------------------------------------------------------------------------------------------


def lm_brute_force(data, weights=None):
    toks = [(i, words(t) + [None]) for i, t in data]
    fold = lambda i: -1 if i is None else crc32(str(i).encode()) % 5
    uni, bi = Counter(), Counter()
    for i, w in toks:
        if fold(i) != 1:
            uni.update(w)
            bi.update(zip([None, *w], w))
    total, types = sum(uni.values()), len(uni)
    out = Counter()
    for i, w in toks:
        base = sum(math.log10((uni[x] + 0.5) / (total + 0.5 * (types + 1))) for x in w)
        score = None
        if weights is not None:
            score = 0.0
            for v, x in zip([None, *w], w):
                l2, l1, l0 = weights[int(math.log2(uni[v])) + 1 if uni[v] else 0]
                score += math.log10(l2 * bi[v, x] / max(uni[v], 1) + l1 * uni[x] / max(total, 1) + l0 / (types + 1))
            score = round(score, 6)
        out[(i, fold(i) == 1, len(w), sum(uni[x] > 0 for x in w), total, round(base, 6), score)] += 1
    return out


def test_lm_scores_equal_brute_force(spark, monkeypatch):
    """Counts and both scores, over many blocks and parts, with the weights that EM found."""
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(lm_score, "PART_KEYS", 2000)
    found = []
    learn = lm_score.learn_weights
    monkeypatch.setattr(lm_score, "learn_weights", lambda cells: found.append(learn(cells)) or found[-1])
    data = rows()
    got = lm_score.score(table(spark, data)).collect()
    w = found[0]
    assert np.allclose(w.sum(axis=1), 1) and (w >= 0).all() and w[0, 0] == 0
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                   for r in got) == lm_brute_force(data, w)


def test_em_finds_the_best_weights():
    rng = np.random.default_rng(3)
    cells = pd.DataFrame({"b": 3, "r2": rng.integers(-40, 60, 300), "r1": rng.integers(-40, 60, 300), "n": rng.integers(1, 50, 300)})
    w = lm_score.learn_weights(cells)[3]
    p = np.column_stack([2.0 ** (cells.r2 / 4), 2.0 ** (cells.r1 / 4), np.ones(300)])
    like = lambda v: float((cells.n * np.log(p @ v)).sum())
    grid = [np.array([a, b, 1 - a - b]) for a in np.linspace(0.001, 0.998, 60) for b in np.linspace(0.001, 0.998, 60) if a + b < 1]
    assert like(w) >= max(map(like, grid)) - 1e-3


def test_lm_empty(spark):
    assert lm_score.score(empty(spark)).count() == 0
    r = lm_score.score(table(spark, [(1, "a b")])).first()
    assert r.n_tokens == 3
