from quern.llm.decontaminate import Containment, drop_leaks, find_leaks

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    out, word = [], ""
    for c in (text or "").lower():
        if c in SPACE:
            out += [word] * bool(word)
            word = ""
        else:
            word += c
    return out + [word] * bool(word)


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, items):
    best = {}
    for d, t in docs:
        has = shingles(t)
        for i, u in items:
            s = shingles(u)
            if s and i is not None and 100 * len(s & has) >= 80 * len(s):
                best[d, i] = max(best.get((d, i), 0), len(s & has) / len(s))
    return best


def got(df):
    return {(r[0], r[1]): r[4] for r in df.collect()}


def test_same_pairs_as_all_against_all(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    expected = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert expected and got(find_leaks(documents, items)) == expected


def test_border_of_containment(spark):
    item = " ".join(f"w{i}" for i in range(24))  # 20 shingles
    noise = " ".join(f"x{i}" for i in range(3000))
    rows = []
    for n in range(15, 25):  # the first n words: n - 4 shingles
        rows.append((n, f"{noise} {' '.join(item.split()[:n])} {noise}"))
    rows.append((99, f"{' '.join(item.split()[:12])} {noise} {' '.join(item.split()[8:])}".upper()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, item), (3, "w0 w1"), (4, None), (None, item)], "item_id long, text string")
    expected = brute(rows, [(1, item), (2, item), (3, "w0 w1")])
    assert (20, 1) in expected and (19, 1) not in expected and (99, 2) in expected
    assert got(find_leaks(docs, items)) == expected
    assert got(find_leaks(docs, items, setup=Containment(broadcast_rows=0))) == expected


def test_hard_rows(spark, hard, nothing):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    items = [(i, t) for i, (_, t) in enumerate(rows)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(find_leaks(hard, bench)) == brute(rows, items)
    assert find_leaks(nothing, bench).collect() == [] and find_leaks(hard, bench.limit(0)).collect() == []
    left = drop_leaks(hard, bench.filter("item_id = 8"))
    assert left.columns == hard.columns and {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {8, 9, 10, None}
