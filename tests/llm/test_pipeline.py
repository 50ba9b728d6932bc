"""The pipeline on a small corpus with one case for every stage."""

import os
import random

import corpus_pipeline as P


def word(r):
    return "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 9)))


def test_stages(spark, tmp_path):
    r = random.Random(1)
    text = lambda n: ". ".join(" ".join(word(r) for _ in range(8)) for _ in range(n)) + "."
    docs, labels, items = [], [], [(k, text(4)) for k in range(5)]
    for k in range(400):
        body = text(6)
        if k % 4 == 0:
            body += " You vile creature."
        docs.append((k, body, "en", f"s{k % 3}", len(body)))
        labels.append((k, 1, int(k % 4 == 0)))
    line = "this very line stands in many of the documents"
    extra = {500: text(5) + "\n" + line, 501: line + "\n" + text(5), 502: text(5) + "\n" + line, 503: text(9), 505: text(5) + " " + items[2][1], 506: "", 507: None}
    extra[504] = extra[503].replace(extra[503].split()[10], "other")
    docs += [(k, t, "en", "x", None) for k, t in extra.items()]
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, at, str(tmp_path))
        assert out.dtypes == at.dtypes, name
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({x["doc_id"]: x["text"] for x in at.collect()})
    assert not [k for k in seen[0] if k < 400 and k % 4 == 0] and len([k for k in seen[0] if k < 400]) == 300
    assert line not in seen[1][500] + seen[1][501] and line in seen[1][502] and set(seen[1]) == set(seen[0])
    assert 503 in seen[2] and 504 not in seen[2] and len([k for k in seen[2] if k < 400]) == 300
    assert set(seen[2]) - set(seen[3]) == {505}
    got = P.run(spark, str(tmp_path))
    assert {x["doc_id"] for x in got.collect()} == set(seen[3]) and got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


ODD_IDS = "doc_id long, text string, lang string, _row int, _score int, rest string"


def tables(spark, folder, docs, items=(), schema=ODD_IDS):
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_rows_with_null_repeated_and_clashing_ids(spark, tmp_path):
    r = random.Random(2)
    text = lambda: " ".join(word(r) for _ in range(40))
    a, b, c, d, leak = (text() for _ in range(5))
    rows = [(3, a), (None, a), (None, b), (7, c), (7, a), (9, d), (9, d), (None, None), (None, ""), (7, leak + " " + c), (None, leak), (1, "short"), (2, "SHORT")]
    docs = tables(spark, str(tmp_path), [(k, t, "en", 1, 2, "x") for k, t in rows], [(1, leak), (2, None)])
    had = lambda df: sorted(((x["doc_id"], x["text"]) for x in df.collect()), key=str)
    kept = P.dedup_near(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    # the empty rows are one group and have no id between them
    assert [x for x in had(kept) if x[1]] == sorted([(3, a), (None, b), (7, c), (9, d), (7, leak + " " + c), (None, leak), (1, "short")], key=str)
    assert len([x for x in had(kept) if not x[1]]) == 1
    clean = P.decontaminate(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and had(clean) == sorted([x for x in rows if leak not in (x[1] or "")], key=str)
    assert had(P.drop_toxic(spark, docs, str(tmp_path))) == sorted(rows, key=str)
    # a is a line of three documents and stays in that of the largest id
    want = [(k, "" if t == a and k != 7 else t or "") for k, t in rows]
    assert had(P.dedup_lines(spark, docs, str(tmp_path))) == sorted(want, key=str)


def test_near_dedup_and_lines_against_brute_force(spark, tmp_path):
    r = random.Random(5)
    rows, lines = [], [" ".join(word(r) for _ in range(6)) for _ in range(12)]
    for k in range(120):
        body = [word(r) for _ in range(60)] if k % 3 == 0 else list(rows[-1][1].split("\n")[0].split(" "))
        if k % 3:
            body[r.randrange(60)] = word(r)
        rows.append((k if k % 5 else None, " ".join(body) + "\n" + r.choice(lines)))
    docs = tables(spark, str(tmp_path), [(k, t, "en", 1, 2, "x") for k, t in rows])
    out = P.dedup_lines(spark, docs, str(tmp_path))
    last, n = {}, {}
    for k, t in rows:
        for key in set(t.split("\n")):
            last[key], n[key] = max(last.get(key, -1), -1 if k is None else k), n.get(key, 0) + 1
    want = [(k, "\n".join(x for x in t.split("\n") if n[x] < 3 or (-1 if k is None else k) == last[x])) for k, t in rows]
    assert sorted(((x["doc_id"], x["text"]) for x in out.collect()), key=str) == sorted(want, key=str)
    out.write.parquet(f"{tmp_path}/lines")
    kept = P.dedup_near(spark, spark.read.parquet(f"{tmp_path}/lines"), str(tmp_path))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in want)]
    top = list(range(len(want)))
    for i in range(len(want)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                top = [top[j] if x == top[i] else x for x in top]
    groups = {}
    for i, g in enumerate(top):
        groups.setdefault(g, []).append(want[i])
    least = sorted((min(g, key=lambda x: (x[0] is None, x[0] or 0))[0] for g in groups.values()), key=str)
    assert sorted((x["doc_id"] for x in kept.collect()), key=str) == least and 40 <= len(groups) < 120


def test_stored_tables_go_with_their_scratch(spark):
    from framespool.llm.common import scratch, stored

    with scratch():
        kept = stored(spark.range(5))
        assert kept.count() == 5 and os.path.isdir(kept.stored_at)
    assert not os.path.exists(kept.stored_at)
    kept = stored(spark.range(5))
    assert os.path.isdir(kept.stored_at)
