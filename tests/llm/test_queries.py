"""Whole queries, every column, against plain restatements; for those that SQL can't express."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from framespool.llm import leaks, pieces, pii, simhash, toxicity

SPACES = " \t\n\x0b\x0c\r"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def words(r, n, letters="abcdefghij"):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Prose, copies, near copies, personal data, odd rows."""
    r = random.Random(12)
    texts = [words(r, r.randint(1, 60)) for _ in range(60)]
    texts += [t.replace("a", "A") for t in texts[:10]] + [t + " x" for t in texts[10:25]] + [t.replace(t.split()[0], "zz", 1) for t in texts[25:40]]
    texts += ["mail a.b@c.org, 10.0.0.1 and 4111 1111 1111 1111", "+1 (555) 123-4567 or me (at) example (dot) com", "192.168.1.1.2 é 日本 ＠ a@b.c", "host one nine two dot one six eight dot one dot two two two"]
    texts += [None, "", " \n\t ", "same", "same", "two words", "\x0b\x0c\r", "x" * 3000, "é " * 400, "  a  b\n\nc "]
    return [(k if k % 17 else None, t, "en", "s", 0) for k, t in enumerate(texts)] + [(5, texts[5], "en", "s", 0)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, corpus):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(corpus, DOCUMENTS).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def same(df, columns, want):
    got = sorted((tuple(x[c] for c in columns) for x in df.collect()), key=str)
    assert got == sorted(want, key=str)


def test_personal_data(spark, folder, corpus):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, text):
        digits = [int(c) for c in text if c in "0123456789"]
        if kind == "ip":
            return all(int(x) <= 255 for x in text.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    want = []
    for doc_id, text, *_ in corpus:
        base = {k: [m.span() for m in re.finditer(p, text or "") if good(k, m[0])] for k, p in patterns.items()}
        listed = ",".join(f"{k}:{a}:{b}" for k in patterns for a, b in base[k])
        want.append((doc_id, *(len(base[k]) for k in patterns), sha(listed)))
    out = pii.op3_personal_data(spark, folder)
    same(out, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"], want)
    # the method's own spans: what is found behind disguises, in order within its kind, base spans staying
    spans = {x["spans"]: (x["base_sha256"], x["n_added"]) for x in out.collect()}
    mail, host = next(t for _, t, *_ in corpus if t and "(at)" in t), next(t for _, t, *_ in corpus if t and t.startswith("host one"))
    at = mail.index("me (at)")
    assert spans[f"email:{at}:{len(mail)},phone:0:17"] == (sha("phone:0:17"), 1) and spans[f"ip:5:{len(host)}"] == (sha(""), 1)


def test_simhash(spark, folder, corpus):
    def fingerprint(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(f"[^{SPACES}]+", lowered)
        shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))

    prints = [fingerprint(t) for _, t, *_ in corpus]
    top = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and top[i] != top[j]:
                top = [top[j] if x == top[i] else x for x in top]
    ids = {}
    for (doc_id, *_), g in zip(corpus, top):
        ids.setdefault(g, []).append(doc_id)
    least = {g: min((k for k in x if k is not None), default=None) for g, x in ids.items()}
    same(simhash.op5_simhash(spark, folder), ["doc_id", "fingerprint", "component_id"], [(k, f"{p:016x}", least[g]) for (k, *_), p, g in zip(corpus, prints, top)])


def test_sentencepiece(spark, folder, corpus):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    want = []
    for doc_id, text, *_ in corpus:
        ids = model.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))))
    same(pieces.op8_sentencepiece(spark, folder), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], want)


def test_chunk_table_is_made_of_the_most_frequent_chunks(spark):
    texts = ["the cat the dog", "the end\nthe cat", "", None, "x" * 100 + " the"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    model = pieces.model_path()
    assert set(pieces.chunk_table(docs, model)) == {"the", "cat", "dog", "end", "\nthe"}
    assert set(pieces.chunk_table(docs, model, size=2)) == {"the", "cat"} and set(pieces.chunk_table(docs, model, size=1)) == {"the"}
    assert set(pieces.chunk_table(docs, model, keep=1)) == {"the"} and pieces.chunk_table(docs.limit(0), model) == {}
    own = pieces.Pieces(model)
    for chunk, entry in pieces.chunk_table(docs, model).items():
        assert entry == own.segmented([chunk])[chunk]


def edits_within(piece, text, most):
    """Least edits of the piece against any substring of the text (Sellers), with an early end."""
    row = np.zeros(len(text) + 1, int)
    codes = np.array([ord(c) for c in text])
    for i, c in enumerate(piece, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)
        new = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        row = new
        if row.min() > most:
            return False
    return row.min() <= most


def test_leaks_against_brute_force(spark, tmp_path):
    """doc_id and item_id of the query: some piece of WINDOW characters lies in the text with EDITS edits or fewer."""
    r = random.Random(6)
    items = [(k, words(r, 24)) for k in range(6)] + [(6, "short one"), (7, None), (None, words(r, 20))]
    docs = []
    for k in range(40):
        text = words(r, 30)
        item = items[k % 6][1]
        if k % 4 == 1:
            text += " " + item
        elif k % 4 == 2:  # a quote with edits, about as long as a piece
            at = r.randrange(len(item) - 80)
            quote = list(item[at : at + r.choice([60, 72, 76, 80])])
            for _ in range(r.randrange(7)):
                quote[r.randrange(len(quote))] = r.choice(["", "q", "zz"])
            text = text[:50] + "".join(quote) + text[50:]
        docs.append((k if k % 9 else None, text))
    docs += [(90, "a Short, one here"), (91, "ashort one"), (92, None), (93, ""), (1, docs[1][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = lambda t: re.sub(r"[^a-z0-9]+", " ", (t or "").lower())
    want = set()
    for item_id, item in items:
        a = plain(item).strip()
        for doc_id, text in docs:
            b = plain(text)
            if a and len(a) < leaks.SHORTEST:
                hit = f" {a} " in f" {b} "
            else:
                size = min(len(a), leaks.WINDOW)
                most = leaks.EDITS * size // leaks.WINDOW
                hit = bool(a) and any(edits_within(a[k : k + size], b, most) for k in range(len(a) - size + 1))
            if hit:
                want.add((doc_id, item_id))
    got = {(x["doc_id"], x["item_id"]) for x in leaks.op2_leaks(spark, str(tmp_path)).collect()}
    assert got == want and len(want) > 15
    kept = {(x["doc_id"], x["text"]) for x in leaks.without_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 200).collect()}
    leaky = set()
    for item in items:
        known = leaks.index([item])
        leaky |= {x for x in docs if leaks.find_leaks(known, x[1])}
    assert kept == set(docs) - leaky and {d for d, _ in leaky} == {d for d, _ in want}


def test_repetitive_texts_are_taken_in_rounds():
    """A text and an item whose q-grams are nearly all equal: many pairs, the same regions."""
    item = "ab " * 60 + "the end of it all comes near"
    text = "ab " * 300 + "the end of it all comes near" + " zz" * 50
    known = leaks.index([(0, item)])
    hashes = leaks.grams(leaks.normalised(text)[0])
    whole, rounds = leaks.candidates(known, hashes), leaks.candidates(known, hashes, most=2000)
    starts = lambda found: {(p, d) for p, d, _, _ in found}
    assert starts(whole) == starts(rounds)
    assert leaks.find_leaks(known, text)


def test_toxicity(spark, tmp_path):
    """Held out by crc32, scores from the text alone and the same for equal texts, held-out accuracy."""
    r = random.Random(7)
    rows = [(k, ". ".join(words(r, 8) for _ in range(5)) + (". You vile wretched creature." if k % 3 == 0 else "."), "en", "s", 0) for k in range(900)]
    rows += [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (None, "You vile wretched creature.", "en", "s", 0), (3, rows[3][1], "xx", "t", 1)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(900)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = toxicity.op7_toxicity(spark, str(tmp_path)).collect()
    assert sorted(x["doc_id"] for x in got if x["doc_id"] is not None) == sorted(k for k, *_ in rows if k is not None) and len(got) == len(rows)
    for x in got:
        assert 0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.5)
        assert x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0)
    held = [x for x in got if x["held_out"] and x["doc_id"] < 900]
    assert len(held) > 100 and sum(x["predicted"] == (x["doc_id"] % 3 == 0) for x in held) >= 0.98 * len(held)
    assert len({x["score"] for x in got if x["doc_id"] == 3}) == 1 and [x["predicted"] for x in got if x["doc_id"] is None] == [1]
    assert [x["score"] for x in got if x["doc_id"] in (1000, 1001)] == [0, 0]
    texts = {k: t for k, t, *_ in rows}
    for x in held:  # the sentence that makes a document toxic is located
        found = [texts[x["doc_id"]][int(a) : int(b)] for a, b in (s.split(":") for s in x["offending"].split(",") if s)]
        assert any("vile" in s for s in found) == (x["doc_id"] % 3 == 0)
    # every score and every located sentence, from the weights alone: one less the chance that no sentence is toxic
    model = toxicity.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    for x in got:
        text, clean, spans = rows[-2][1] if x["doc_id"] is None else texts[x["doc_id"]] or "", 1.0, []
        for m in re.finditer(r"[^.!?\n]+[.!?]*", text):
            if m[0].strip():
                total = model.bias
                for w in set(re.findall(r"\w+", m[0].lower())):
                    total += model.weights.get(w, 0) + sum(model.weights.get(f, 0) for f in ("<" + w[:4], w[-4:] + ">") if len(w) > 4) + (model.weights.get("<" + w[:5], 0) if len(w) > 5 else 0)
                odds = 1 / (1 + np.exp(-min(max(total, -30), 30)))
                clean *= 1 - odds
                spans += [f"{m.start()}:{m.end()}"] if odds >= 0.5 else []
        assert x["score"] == pytest.approx(1 - clean, abs=1e-9) and x["offending"] == ",".join(spans)
