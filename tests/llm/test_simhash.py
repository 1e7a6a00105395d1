import random

import pytest
import xxhash

from maskmetrics.llm.simhash import connected, fingerprint, keep_one, near_duplicates, near_links

BLANKS = " \t\n\x0b\x0c\r"


def _plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in "".join(" " if c in BLANKS else c for c in low).split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(items):
    """items: (key, mark); the smallest reachable key by mark."""
    marks = sorted({m for _, m in items})
    root = {m: m for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(marks):
        for b in marks[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for key, m in items:
        if key is not None:
            least[find(m)] = min(key, least.get(find(m), key))
    return {m: least.get(find(m)) for m in marks}


@pytest.mark.parametrize("text", ["", " \n", "One", "a b", "A B C", "a b c d e f", "É é x\x1cy z the THE", "\x0b" + "w " * 500])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == _plain(text)


def _signed(m):
    return m - (1 << 64) if m >> 63 else m


@pytest.mark.parametrize("dense", [1, 3, 32])
def test_links_connect_what_pairs_connect(spark, dense):
    rng = random.Random(dense)
    marks = {0, 3, 1 << 63, (1 << 64) - 1}
    for _ in range(12):
        m = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 25])):
            marks.add(m)
            for _ in range(rng.randint(0, 4)):
                m ^= 1 << rng.randrange(64)
    links = near_links(spark.createDataFrame([(_signed(m),) for m in marks], "mark long"), 2, dense=dense)
    for r in links.collect():
        assert 0 < (r["a"] % (1 << 64) ^ r["b"] % (1 << 64)).bit_count() <= 2
    roots = {r["node"]: r["root"] for r in connected(links).collect()}
    want = _groups([(_signed(m), m) for m in marks])
    groups, ours = {}, {}
    for m in marks:
        groups.setdefault(want[m], set()).add(m)
        ours.setdefault(roots.get(_signed(m), _signed(m)), set()).add(m)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


def _rows():
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "to", "in"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(120)) for _ in range(8)]
    rows = []
    for i, b in enumerate(base):
        for j in range(6):
            w = b.split()
            for _ in range(j // 2):
                w[rng.randrange(len(w))] = "changed"
            rows.append((100 - 6 * i - j, " ".join(w)))
    return rows + [(1, None), (2, ""), (3, " "), (None, base[0]), (None, "only nameless rows here"), (None, "only nameless rows here"),
                   (7, "short"), (7, "short"), (8, "short")]


def test_components_and_survivors(spark):
    rows = _rows()
    df = spark.createDataFrame([(k, t, "x", k) for k, t in rows], "doc_id long, text string, digest string, component long")
    want = _groups([(k, _plain(t or "")) for k, t in rows])
    got = near_duplicates(df).collect()
    assert sorted((r["doc_id"] or -1, r["fingerprint"] % (1 << 64), r["component"] or -1) for r in got) == sorted(
        (k or -1, _plain(t or ""), want[_plain(t or "")] or -1) for k, t in rows)
    kept = keep_one(df).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == sorted({c or -1 for c in want.values()})
    assert kept[0].asDict().keys() == {"doc_id", "text", "digest", "component"}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(none).count() == 0 and keep_one(none).count() == 0


def test_groups_that_share_a_key_keep_a_row_each(spark):
    texts = ["one text of a few words", "quite another line that says more than that"]
    df = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[0]), (3, texts[1])], "doc_id long, text string")
    assert sorted(tuple(r) for r in keep_one(df).collect()) == [(1, texts[0]), (1, texts[1])]
