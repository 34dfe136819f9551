"""The pipeline's stages, each against brute force on its own input, and the registered queries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from brute import groups, leaks, quality, repeats
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline


def tables(spark, path):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ture", "en"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, items = prose(60), [prose(30) for _ in range(4)]
    docs = []
    for i in range(40):
        text = "\n".join(prose(rng.randint(8, 20)) for _ in range(rng.randint(2, 6)))
        if i % 6 == 0:
            text += "\n" + passage
        if i % 9 == 0:
            text += "\n" + items[i % 4]
        docs.append((i, text, "en", f"s{i % 2}", len(text)))
    docs += [(100 + i, docs[i][1].replace(docs[i][1].split()[3], "zz", 1), "en", "s0", 0) for i in range(8)]
    docs += [(200, docs[1][1], "en", "s1", 5), (201, None, None, None, None), (None, prose(50), "en", "s1", 0), (202, "short", "en", "s1", 5), (203, prose(9) * 5, "en", "s1", 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return items


def test_stages_against_brute_force(spark, workdir):
    items = tables(spark, workdir)
    docs = spark.read.parquet(f"{workdir}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "repeated_strings", "decontamination", "bpe_codes"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        pairs = [(i, t) for i, t, _ in before]
        stage(spark, docs, workdir).write.parquet(f"{workdir}/{name}")
        docs = spark.read.parquet(f"{workdir}/{name}")
        after = docs.collect()
        if name != "bpe_codes":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in after if (r.doc_id, r.text) not in pairs)
        got = sorted(((r.doc_id, r.text) if name != "bpe_codes" else tuple(r) for r in after), key=repr)
        if name == "quality_rules":
            want = [(w[0], left if w[7] else t) for (w, left), (_, t, _) in zip(quality(before), before) if w[8]]
        elif name == "near_duplicates":
            group, sizes = groups(pairs, 5)
            best = {}
            for (i, _), g in zip(pairs, group):
                best[g] = min(best.get(g, (2, 0)), (i is None, i or 0))
            want = [p for p, g, n in zip(pairs, group, sizes) if not n or (p[0] is None, p[0] or 0) == best[g]]
        elif name == "repeated_strings":
            want = [(i, w[5].decode(errors="ignore")) for (i, _), w in zip(pairs, repeats(pairs, 200))]
            assert any(w[2] for w in repeats(pairs, 200))
        elif name == "decontamination":
            want = [p for p, hit in zip(pairs, leaks(pairs, list(enumerate(items)))) if not hit[5]]
            assert len(want) < len(pairs)
        else:
            library, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
            for i, t in pairs:
                ids = library.encode(t, add_special_tokens=False).ids
                text = library.decode(ids, skip_special_tokens=False)
                want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert got == sorted(want, key=repr), name
    whole = corpus_pipeline.run(spark, workdir)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, docs.collect()))


def test_every_operator_has_its_query():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


@pytest.mark.parametrize("name", ["op8_url_filter", "op9_quality_rules"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    smoke = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke}/{t}.parquet')")
    got = entry.queries()[name](spark, smoke)
    names = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want))
