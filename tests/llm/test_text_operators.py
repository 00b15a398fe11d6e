"""Personal data, chat, fingerprints, language, shards, packing and pages on the smallest tables and odd ones."""

import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute
from hailgrid.llm import chat, language, minhash, packing, pages, pii, shards
from hailgrid.llm.catalog import QUERIES
from test_corpus import ODD, SF_DIR, documents, frame, ordered, rows

# ---- personal data

PRIVATE = [
    (1, None),
    (2, ""),
    (3, "a.b+c@mail-1.example.org, x@y (x@y.z) @no.de q@@w.ex a@b@c.de a@b.c@d.ef"),
    (4, "1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 01.002.0003.4 0000000000.1.1.1 1..2.3.4"),
    (5, "4111 1111 1111 1111, 4111-1111-1111-1111 12 4111111111111111 4111111111111112 " + "4" * 400),
    (6, "+1 (017) 555-7713 +1 (017) 555-7713 190.137.2.1 +12 +123456789012345678 ++1 2345678901"),
    (7, "9" * 5000 + "." + "9" * 5000),
    (7, "@" * 3000),
    (None, "é+49 30 1234567x ü1.1.1.1ü"),
]


def test_pii(spark):
    _, data = documents(spark)
    got = {r["doc_id"]: r for r in QUERIES["op1_pii"](spark, SF_DIR).collect()}
    assert len(got) == len(data)
    for doc_id, text in data:
        want, r = brute.base_spans(text), got[doc_id]
        names = [f"{kind}:{a}:{b}" for a, b, kind in want]
        assert r["base_sha256"] == brute.sha(",".join(names))
        assert set(names) <= set(r["spans"].split(",") if r["spans"] else [])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in want) for k in pii.KINDS]


@pytest.mark.parametrize("text", [t for _, t in PRIVATE])
def test_base_spans(text):
    assert pii.base_spans(text or "") == brute.base_spans(text)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789..--  +()@aZ%é\n") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == brute.base_spans(text)


def test_pii_odd(spark):
    docs = frame(spark, PRIVATE)
    got = pii.personal_data(docs).collect()
    assert ordered((r["doc_id"], tuple((s["start"], s["stop"], s["kind"]) for s in r["base"])) for r in got) == ordered((i, tuple(brute.base_spans(t))) for i, t in PRIVATE)
    assert pii.pii_digest(frame(spark, [])).count() == 0
    out = pii.redacted(docs)
    assert out.columns == docs.columns and out.count() == len(PRIVATE)
    want = [(r["doc_id"], r["text"] and pii.replaced(r["text"], [(s["start"], s["stop"], s["kind"]) for s in r["spans"]])) for r in got]
    assert rows(out, "doc_id", "text") == ordered(want)


def test_skip_edges_carry_a_label_across_the_document():
    sure = ["card 4111111111111111 end"] * 200 + ["just 12 words and 34 more"] * 200
    f = pii.factors([(*k, n) for k, n in pii.fit_counts(sure).items()])
    lost = "no. 12 4111111111111111 " + "word " * 500  # two numbers in one match: the pattern drops both
    found = "card 4111111111111111 end"
    assert pii.base_spans(lost) == []
    [(base, spans)] = pii.find_spans([lost + found], f)
    assert len(base) == 1
    assert (7, 23, "card") in spans and all(s in spans for s in base)
    g = pii.graph("x 12a45b7 y 12A-45-B7", [])
    assert g.skips == [(0, 1)]


def test_posteriors_are_exact_on_a_chain():
    f = pii.factors([("node", "91:", 0, 50), ("node", "91:", 2, 30), ("chain", "0", 0, 40), ("chain", "2", 2, 20), ("chain", "0", 2, 10), ("skip", "2", 2, 5)])
    g = pii.graph("1 2 3", [])
    n = len(pii.LABELS)
    joint = np.zeros((n, n, n))
    for y in np.ndindex(n, n, n):
        joint[y] = sum(f.node["91:"][v] for v in y) + f.chain[y[0], y[1]] + f.chain[y[1], y[2]] + f.chain[0, y[0]] + f.chain[0, y[2]]
    joint = np.exp(joint)
    exact = np.stack([joint.sum(axis=tuple(a for a in range(3) if a != k)) for k in range(3)]) / joint.sum()
    assert np.allclose(pii.posteriors([g], f), exact, atol=1e-2)


def test_one_certain_occurrence_reaches_hundreds():
    lone = "no. 12 4111111111111111 and "
    sure = ["card 4111111111111111 end"] * 200 + ["just 12 words and 34 more"] * 200 + [lone] * 800
    f = pii.factors([(*k, n) for k, n in pii.fit_counts(sure).items()])
    for before, after in ((300, 0), (0, 300), (150, 150)):
        text = lone * before + "card 4111111111111111 end " + lone * after
        [(base, spans)] = pii.find_spans([text], f)
        assert len(base) == 1 and len(spans) == 301 and {text[a:b] for a, b, _ in spans} == {"4111111111111111"}


CARD_FORMS = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "41111111 11111111", "4111-1111 1111 1111"]
PHONE_FORMS = ["1 (555) 123-4567", "15551234567", "1 555 123 4567", "1.555.123.4567"]


def form_factors():
    sure = [f"card {x} end and +1 (555) 123-45{n:02} end" for x in CARD_FORMS for n in range(60)] + ["just 12 words and 34 more (5) or 1 and 4567 of 1111"] * 600
    return pii.factors([(*k, n) for k, n in pii.fit_counts(sure).items()])


def test_forms_of_one_number_are_tied_and_added_whole():
    f = form_factors()
    for kind, sure, forms in (("card", "4111 1111 1111 1111", CARD_FORMS), ("card", "4111111111111111", CARD_FORMS), ("phone", "+1 (555) 123-4567", PHONE_FORMS)):
        for form in forms:
            text = f"no. 123 {form} 77 and more words, once {sure} end, then 812 {form} 99"
            [(base, spans)] = pii.find_spans([text], f)
            assert [text[a:b] for a, b, _ in base] == [sure]
            added = [(text[a:b], k) for a, b, k in spans if (a, b, k) not in base]
            assert added == [(form, kind)] * 2, (text, added)


def test_a_phone_that_an_address_follows_is_still_found():
    f = form_factors()
    [(base, spans)] = pii.find_spans(["un. +1 (826) 555-4081 190.137.2.11 x"], f)
    assert [s[2] for s in base] == ["ip"] and (4, 21, "phone") in spans


def test_numbers_with_other_digits_stay_apart():
    text = "card 4111 1111 1111 1111 end, 4111 1111 1111 1112 and x4111 1111 1111 1111 or 4111 1111 1111 11119"
    [(base, spans)] = pii.find_spans([text], form_factors())
    g = pii.graph(text, base)
    assert len(base) == 2 and (5, 24) in g.spans
    assert all({text[a:b].replace(" ", "") for a, b in (g.spans[x], g.spans[y])} <= {"4111111111111111", "x4111111111111111"} or len(text[slice(*g.spans[x])]) < 16 for x, y in g.skips)


def test_messages_cross_a_long_chain():
    n = len(pii.LABELS)
    f = pii.Factors({"91:": np.zeros(n)}, np.zeros(n), np.where(np.eye(n, dtype=bool), 6.0, 0.0), np.zeros((n, n)))
    g = pii.graph(" ".join("1" * 100), [])
    g.labels[0], g.alone[:] = 2, 0
    exact = [np.eye(n)[2]]
    step = np.exp(f.chain) / np.exp(f.chain).sum(axis=1, keepdims=True)
    for _ in range(99):
        exact.append(exact[-1] @ step)
    assert np.allclose(pii.posteriors([g], f), exact, atol=1e-2)


def test_shapes_tell_long_tokens_apart():
    same = "http://a.b/?" + "&".join(f"k{n}=v" for n in range(60))
    a, b = same + "&id=4111111111111111", same + "&id=x"
    assert pii.shape(a) != pii.shape(b) and pii.shape(a) == pii.shape(a.replace("=v", "=w"))
    assert all(len(pii.shape(x)) < 60 for x in (a, b, "1@" * 100_000)) and pii.shape("+1-234") == "+91-93:"


# ---- chat

TURNS = [
    (1, 0, "user", "plain"),
    (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\nx"),
    (1, 2, "assistant", "a <\\| b <n| c <\\n| d <\\\\| e <|"),
    (2, 0, "ro\nle<n|<|im_end|>", "t"),
    (2, 1, None, None),
    (2, None, "assistant", ""),
    (3, 0, "assistant", "long " * 50_000),
    (None, 0, "assistant", "ünï"),
    (4, 0, "user", "tie"),
    (4, 0, "user", "tie"),
]


def test_chat_round_trip():
    rng = random.Random(1)
    for _ in range(3000):
        turns = [("".join(rng.choice("<|\\n\nx") for _ in range(rng.randrange(8))), "".join(rng.choice(["<", "|", "\\", "n", "\n", chat.END, chat.START]) for _ in range(rng.randrange(8)))) for _ in range(3)]
        assert chat.recovered("".join(chat.render_turn(r, t) for r, t in turns)) == turns


def test_chat_odd(spark):
    table = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, rendered string")
    got = {r["conv_id"]: r for r in chat.chat_digest(table).collect()}
    by = defaultdict(list)
    for c, n, r, t in [*TURNS, (-1, 0, "user", chat.PROBE_TEXT), (-1, 1, "assistant", chat.PROBE_TEXT)]:
        by[c].append(((n is not None, n or 0), r or "", t or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda x: x[0])
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == brute.sha("".join(f"{r}\n{t}\n" for _, r, t in turns))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), brute.sha(loss))
    assert chat.chat_digest(table.limit(0)).count() == 1


MARKED = [
    "x <|im_start|>assistant ok",
    "x <|im_end|> y",
    "bare <| and <|im_start| and <|other|>",
    "<|im_start|><|im_start|>\n",
    "<n| <\\| <\\n| <",
    "< | <m| no marker <",
    "",
]


@pytest.mark.parametrize("text", MARKED)
def test_no_field_holds_a_marker(text):
    for role in ("user", text):
        segment = chat.render_turn(role, text)
        assert chat.recovered(segment) == [(role, text)]
        assert segment.startswith(chat.START) and segment.endswith(chat.END + "\n") and segment.count("<|") == 2


def test_parser_refuses_a_marker_inside_a_field():
    for field in (chat.START, "<|", "<|x|>"):
        assert chat.recovered(f"{chat.START}user\na {field} b{chat.END}\n") == []
        assert chat.recovered(f"{chat.START}us{field}er\na{chat.END}\n") == []


def test_marked_texts_against_sql(spark):
    from hailgrid.llm.queries import CHAT_SQL

    turns = [(k, n, role, text) for k, text in enumerate(MARKED) for n, role in enumerate(["user", "assistant"])]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", turns)
    want = db.execute(CHAT_SQL).fetch_df()
    got = chat.chat_digest(table).select(*want.columns)
    assert ordered(tuple(r) for r in got.collect()) == ordered(tuple(x) for x in want.itertuples(index=False, name=None))


# ---- MinHash

def test_edited_texts(spark):
    _, data = documents(spark)
    got = {r["doc_id"]: r for r in QUERIES["op3_minhash"](spark, SF_DIR).collect()}
    assert len(got) == len(data)
    errors = []
    for doc_id, n, text, own, after in brute.edited(data):
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (n, brute.sha(text))
        errors += [r["near_edited"] - jaccard(own, text), r["near_next"] - jaccard(own, after)]
        assert abs(r["jaccard_edited"] - jaccard(own, text)) < 1e-12 and abs(r["jaccard_next"] - jaccard(own, after)) < 1e-12
        for near in ("edited", "next"):
            assert 4 * r[f"bands_{near}"] <= round(128 * r[f"near_{near}"]) and (r[f"bands_{near}"] or r[f"jaccard_{near}"] < 0.8)
        if own == after:
            assert r["near_next"] == 1.0
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def shingles(text):
    words = brute.WORD.findall(text.translate(brute.LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_odd(spark):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in minhash.edited_fingerprints(frame(spark, ODD)).collect())
    assert got == sorted((i is None, i or 0, n, brute.sha(t)) for i, n, t, _, _ in brute.edited(ODD))
    assert minhash.edited_fingerprints(frame(spark, [])).count() == 0
    [one] = minhash.edited_fingerprints(frame(spark, [(5, "abcd")])).collect()
    assert one["edited_sha256"] == brute.sha("abab") and one["near_next"] == 1.0


def test_near_duplicates(spark):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words), " ".join(words[:395]), " ".join(words[:200]), " ".join(words), "w1 w2", None, " ".join(words[5:]), "", "  ", "\n"]
    docs = frame(spark, list(enumerate(texts)))
    got = {(r["a"], r["b"]): r["jaccard"] for r in minhash.near_duplicates(docs).collect()}
    assert set(got) == {(0, 1), (0, 6), (1, 6)}
    assert all(abs(v - jaccard(texts[a], texts[b])) < 1e-9 for (a, b), v in got.items())


# ---- language

def test_language(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in table.collect()}
    got = QUERIES["op4_language"](spark, SF_DIR).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in set(lang.values()) | {"und"} for r in got)


def test_language_odd(spark):
    docs = frame(spark, [*ODD, (20, "12 34 !!")])
    got = {(r["doc_id"], r["lang_pred"], r["rejected"]) for r in language.languages(docs).collect()}
    assert {(1, "und", True), (2, "und", True), (3, "und", True), (20, "und", True), (5, "en", False)} <= got
    assert language.languages(frame(spark, [])).count() == 0
    nothing = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r["lang_pred"] for r in language.languages(nothing).collect()} == {"und"}
    known = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    strange = frame(spark, [(1, "zzqxj " * 80), (2, "the thing and the other for that with")])
    assert [r["rejected"] for r in language.languages(strange, known).orderBy("doc_id").collect()] == [True, False]


FOREIGN = {
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza. Ad ogni individuo spettano tutti i diritti e tutte le libertà enunciate nella presente Dichiarazione, senza distinzione alcuna, per ragioni di razza, di colore, di sesso, di lingua, di religione, di opinione politica o di altro genere, di origine nazionale o sociale, di ricchezza, di nascita o di altra condizione. Nessun individuo potrà essere tenuto in stato di schiavitù o di servitù.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokainen on oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin ja vapauksiin ilman minkäänlaista rotuun, väriin, sukupuoleen, kieleen, uskontoon, poliittiseen tai muuhun mielipiteeseen, kansalliseen tai yhteiskunnalliseen alkuperään, omaisuuteen, syntyperään tai muuhun tekijään perustuvaa erotusta. Ketään ei saa pitää orjana tai orjuutettuna.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. Herkes, ırk, renk, cinsiyet, dil, din, siyasi veya diğer herhangi bir akide, milli veya içtimai menşe, servet, doğuş veya herhangi diğer bir fark gözetilmeksizin işbu Beyannamede ilan olunan bütün haklardan ve bütün hürriyetlerden istifade edebilir. Hiç kimse kölelik veya kulluk altında bulundurulamaz.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności zawarte w niniejszej Deklaracji bez względu na różnice rasy, koloru, płci, języka, wyznania, poglądów politycznych i innych, narodowości, pochodzenia społecznego, majątku, urodzenia lub jakiegokolwiek innego stanu.",
    "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen. Een ieder heeft aanspraak op alle rechten en vrijheden, in deze Verklaring opgesomd, zonder enig onderscheid van welke aard ook, zoals ras, kleur, geslacht, taal, godsdienst, politieke of andere overtuiging, nationale of maatschappelijke afkomst, eigendom, geboorte of andere status.",
}
LEARNT = {
    "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. Everyone is entitled to all the rights and freedoms set forth in this Declaration, without distinction of any kind.",
    "fr": "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité. Chacun peut se prévaloir de tous les droits et de toutes les libertés proclamés dans la présente Déclaration.",
    "de": "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen. Jeder hat Anspruch auf die in dieser Erklärung verkündeten Rechte und Freiheiten ohne irgendeinen Unterschied.",
    "es": "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros. Toda persona tiene todos los derechos y libertades proclamados en esta Declaración, sin distinción alguna de raza, color.",
}


def test_long_texts_of_other_languages_are_rejected(spark):
    known = spark.read.parquet(f"{os.path.dirname(SF_DIR)}/sf0.1/documents.parquet")
    model = language.fitted_model(known)
    for text in FOREIGN.values():
        assert model.predict([text, text + " " + text, " ".join([text] * 8)])[2].all()
    for lang, text in LEARNT.items():
        labels, _, rejected = model.predict([text, " ".join([text] * 5)])
        assert labels == [lang, lang] and not rejected.any()
    short = [r["text"] for r in known.filter("length(text) < 200").collect() if language.has_letter(r["text"])]
    gone = np.concatenate([model.predict(short[a:b])[2] for a, b in language.chunks(short)])
    assert len(short) > 100 and gone.sum() <= 0.005 * len(short) + 1


def test_one_odd_short_text_does_not_set_the_bar_for_long_ones():
    rng = random.Random(2)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(200)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in [6] * 100 + [300] * 400]
    bar = [language.train(language.ngram_counts(t).astype(np.float32), ["en"] * len(t)).least for t in (texts, [*texts, "zqxj wvkq"])]
    long = language.size_class(language.ngram_counts([texts[-1]]))[0]
    assert bar[1][long] > 0.95 * bar[0][long] and bar[1][long] > 1.2 * bar[0][0]


# ---- shards

def check_shards(got, data, n):
    size = lambda t: len((t or "").encode()) + 16
    assert len(got) == len(data)
    assert ordered((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == ordered((i, size(t), zlib.crc32((t or "").encode())) for i, t in data)
    slots, loads = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    groups = Counter()
    for _, t in data:
        groups[t or ""] += size(t)
    assert sorted([*loads.values(), *[0] * (n - len(loads))]) == brute.lpt_loads(groups.values(), n)
    where = defaultdict(set)
    for r in got:
        where[r["text_crc32"]].add(r["shard"])
    return where


def test_shards(spark):
    _, data = documents(spark)
    where = check_shards(QUERIES["op6_shards"](spark, SF_DIR).collect(), data, 40)
    assert all(len(x) == 1 for x in where.values())


@pytest.mark.parametrize("n", [1, 3, 40])
def test_shards_odd(spark, n):
    check_shards(shards.shard_digest(frame(spark, ODD), n).collect(), ODD, n)
    assert shards.shard_digest(frame(spark, []), n).count() == 0


def test_longest_first_is_what_a_plain_loop_gives():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 8)
        sizes = Counter(rng.randrange(1, 30) for _ in range(rng.randrange(0, 200)))
        loads = Counter()
        for size, runs in shards.longest_first(list(sizes.items()), n):
            before = 0
            for upto, shard in runs:
                loads[shard] += (upto - before) * size
                before = upto
            assert before == sizes[size]
        assert sorted([*loads.values(), *[0] * (n - len(loads))]) == brute.lpt_loads(sizes.elements(), n)


# ---- packing

def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*x.ids, 2] for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_packing(got, data, capacity=1024):
    ids = defaultdict(list)
    for (doc_id, _), own in zip(data, reference_ids([t for _, t in data]), strict=True):
        first = len(own) % capacity or capacity
        bounds = [0, *range(first, len(own) + 1, capacity)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            ids[doc_id, k].append((a, b - a, zlib.crc32(np.array(own[a:b], "<u4").tobytes())))
    assert ordered((k, tuple(sorted(v))) for k, v in ids.items()) == ordered(
        (k, tuple(sorted((r["start"], r["length"], r["ids_crc32"]) for r in v))) for k, v in by_key(got).items()
    )
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in got)


def by_key(got):
    out = defaultdict(list)
    for r in got:
        out[r["doc_id"], r["piece"]].append(r)
    return out


def test_packing(spark):
    _, data = documents(spark)
    sequences, tokens = check_packing(QUERIES["op7_packing"](spark, SF_DIR).collect(), data)
    assert sequences <= 1.03 * -(-tokens // 1024)


def test_packing_odd(spark):
    special = [*ODD, (30, "x<|endoftext|>y"), (31, "'s 't  \n\n  it's 　 12٣ "), (32, "a " * 1023)]
    check_packing(packing.packed(frame(spark, special)).collect(), special)
    assert packing.packed(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 1025, 5000), rng.integers(1, 60, 3000), np.minimum(rng.lognormal(5.8, 0.8, 8000).astype(int) + 1, 1024), rng.integers(513, 700, 500), np.full(7, 300), rng.integers(1, 2, 1)][seed]
    supply = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    plan = packing.packing_plan(supply)
    used = Counter()
    for own, n in plan:
        assert sum(own) <= 1024 and n > 0
        for length in own:
            used[length] += n
    assert used == supply
    least = max(-(-int(lengths.sum()) // 1024), int((lengths > 512).sum()))
    assert sum(n for _, n in plan) <= 1.02 * least + 2


# ---- pages

PAGES = [
    ("<html><body><nav>menu</nav><article><h1>T</h1><p>One &amp; <b>two</b>\n three.<p>Short.</article><footer>f</footer>", "T\n\nOne & two three.\n\nShort."),
    ("<body><div class='sidebar'>s s s</div><div id=main-text><h2>Head</h2><p>" + "Text here. " * 30 + "</p><p>End.</p></div><div class=comments><p>" + "me too " * 80 + "</p></div>", "Head\n\n" + ("Text here. " * 30).strip() + "\n\nEnd."),
    ("<main><header><h1>A title</h1></header><p>Body<br>text</p><aside>x</aside><form><p>mail</p></form><script>var a='<p>no</p>';</script><ul><li>1<li>2</ul></main>", "A title\n\nBody text\n\n1\n\n2"),
    ("<article><p>a<!-- c --> b</p><div class='ad'>buy</div><p hidden>h</p><section id=comments><p>c</p></section></article><div><p>outside</p></div>", "a b"),
    ("", ""),
    (None, ""),
    ("<nav>only menu</nav>", ""),
    ("plain words", "plain words"),
    ("<article><p>cut off in the mid", "cut off in the mid"),
    ("<article><p>x &lt;b&gt; &#233; &nbsp; y</p><table><tr><td>1</td><td>2</td></tr></table></article></div></div>", "x <b> é y\n\n1 2"),
]


@pytest.mark.parametrize("html, want", PAGES)
def test_page(html, want):
    assert pages.main_text(html or "") == want


LONG = " ".join(f"Sentence {k} of a text that goes on for a while." for k in range(12))
NAMED = [
    (f"<body><div id='page' class='site right-sidebar'><p>{LONG}</p><p>End.</p></div></body>", f"{LONG}\n\nEnd."),
    (f"<div class='content has-sidebar'><h1>Title</h1><p>{LONG}</p><p>End.</p></div>", f"Title\n\n{LONG}\n\nEnd."),
    (f"<article class='post comments-open'><h1>Title</h1><p>{LONG}</p></article>", f"Title\n\n{LONG}"),
    (f"<article class=sidebar id=comments><p>{LONG}</p></article>", LONG),
    (f"<div class='search-result article'><p>{LONG}</p></div><div class=sidebar><p>s s</p></div>", LONG),
    (f"<div class=widget><article><p>{LONG}</p></article></div>", LONG),
    (f"<div class=notice><p>{LONG}</p></div>", LONG),
    (f"<article><div class=notice><p>{LONG}</p></div><div class=notice><p>Sale!</p></div></article>", LONG),
    (f"<article><p>See <a class='related' href=x>the other one</a> and <span class='notice'>this</span>. {LONG}</p></article>", f"See the other one and this. {LONG}"),
    (f"<article><p>{LONG}</p><p><a class=share href=x>Share</a></p><div class=share-buttons><a href=a>A</a><a href=b>B</a><a href=c>C</a></div></article>", LONG),
    (f"<article><p>a <span hidden>gone</span> b. {LONG}</p></article>", f"a b. {LONG}"),
    (f"<div><p>{LONG}</p></div><div class=comments><p>{LONG[:200]}</p></div>", LONG),
    (f"<article><table><tr><td>1</td><td class=ad>buy</td><td>2</td></tr></table><p>{LONG}</p></article>", f"1 2\n\n{LONG}"),
]


@pytest.mark.parametrize("html, want", NAMED)
def test_a_name_alone_takes_no_article_out(html, want):
    assert pages.main_text(html) == want


def test_many_nested_names():
    html = "<div class=sidebar>" * 3000 + f"<p>{LONG}</p>" + "</div>" * 3000
    assert pages.main_text(html) == LONG


def test_pages(spark):
    got = {r["page_id"]: r for r in QUERIES["op10_pages"](spark, SF_DIR).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        import html

        article = r["html"].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        want = "\n\n".join(x for x in blocks if x)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (want, len(want), r["url"])


def test_pages_odd(spark):
    table = spark.createDataFrame([(k, None, h, "x") for k, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    assert [r["text"] for r in pages.page_texts(table).orderBy("page_id").collect()] == [w for _, w in PAGES]
    assert pages.page_texts(table.limit(0)).count() == 0


# ---- SQL twins

@pytest.mark.parametrize("name", ["op2_chat", "op5_decontaminate", "op8_substring_dedup"])
def test_sql(spark, name):
    from hailgrid.llm.catalog import ORACLES

    db = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    want = db.execute(ORACLES[name]).fetch_df()
    assert set(want.columns) == set(df.columns)
    assert ordered(tuple(r) for r in df.select(*want.columns).collect()) == ordered(tuple(x) for x in want.itertuples(index=False, name=None))
