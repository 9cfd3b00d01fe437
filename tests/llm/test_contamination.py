import hashlib
import random
import re

import pytest

from sparkwatch.llm.contamination import contamination


def words(text):
    plain = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain)


def brute(docs, items, window=13):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for name, item in items:
            t = words(item)
            n = min(window, len(t))
            for q in range(len(t) - n + 1) if t and name is not None else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == t[q : q + n]:
                        hit.update(range(p, p + n))
                        found.add(str(name))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(df, items, **more):
    rows = contamination(df, items, **more).collect()
    return sorted(
        ((r.row.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows), key=str
    )


def tables(seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 3, 12, 13, 20, 40])))) for i in range(12)]
    items += [(100, items[3][1]), (3, items[3][1])]
    docs = []
    for i in range(40):
        parts = [" ".join(rng.choice(pool).upper() for _ in range(rng.choice([0, 3, 30, 300])))]
        for _ in range(rng.randrange(3)):
            own = rng.choice(items)[1].split()
            a = rng.randrange(len(own) + 1)
            parts.append(rng.choice(["-- ", ", ", "é! "]).join(own[a : a + rng.choice([5, 13, 40])]))
        docs.append((i, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("bytes_", [1 << 24, 4000])
def test_equals_brute_force(spark, bytes_):
    docs, items = tables(bytes_)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(df, bench, block_bytes=bytes_) == brute(docs, items)


def test_spans(spark):
    item = " ".join(f"t{i}" for i in range(14))
    df = spark.createDataFrame([(1, f"a b {item} c")], "doc_id long, text string")
    bench = spark.createDataFrame([("x", item)], "item_id string, text string")
    row = contamination(df, bench).first()
    assert [(s.start, s.end) for s in row.spans] == [(2, 15), (3, 16)] and row.n_hit == 14


def test_odd_rows(spark):
    item = " ".join(f"t{i}" for i in range(13))
    docs = [(1, None), (2, ""), (None, item), (3, item), (3, item), (4, item + " z" * 100_000)]
    items = [(1, None), (2, ""), (None, item), (7, item), (7, item)]
    df = spark.createDataFrame([(*d, True) for d in docs], "doc_id long, text string, contaminated boolean")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(df, bench) == brute(docs, items)
    assert len(got(df, bench.limit(0))) == len(docs)
    assert got(df.limit(0), bench) == []
