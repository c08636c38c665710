"""Alignment, SimHash and the Merkle manifest against brute force, with every awkward row."""

import bisect
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from small import LOWER, frame, make, plain, words_of

from pyspark.sql import functions as F
from strata.llm import alignment, merkle, simhash

STRANGE = [
    (950, "a <|endoftext|> b </s> <s> <0x41> \x00 \x01", "en", "b", 1), (951, "a▁b ▁", "en", "b", 1), (952, " ", "en", "b", 1),
    (953, "日本語のテキスト 😀 é ﬁ  x", None, "b", 1), (954, "\n\n\t tab  two  blanks ", "en", "", 1), (955, "ÄÖÜ ABC xyz", "de", "b", 1),
]


@pytest.fixture(scope="module")
def rows():
    return make() + STRANGE


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def tokens(text):
    """Ids and byte ends of both tokenizers, from the tokenizers' own files."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(tokens, "a"):
        tokens.a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        tokens.a.encode_special_tokens = True
        tokens.b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printable)}
        tokens.byte = {c: b for b, c in shown.items()}
    if not text:
        return [], []
    a = [(i, bytes(tokens.byte[c] for c in tokens.a.id_to_token(i))) for i in tokens.a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in tokens.b.encode(text):
        piece = tokens.b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if tokens.b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(pieces):
    out, at = [], 0
    for i, piece in pieces:
        out.append((i, at, at + len(piece)))
        at += len(piece)
    return out


def brute_alignment(rows):
    found, counts = [], Counter()
    for doc_id, text, *_ in rows:
        a, b = map(spans, tokens(text))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] if len(a) < 200 else overlaps(a, b)
        ends = sorted({e for *_, e in a} & {f for *_, f in b})
        sides = [[[] for _ in ends], [[] for _ in ends]]
        for side, held in zip((a, b), sides, strict=True):
            for i, s, _ in side:
                held[bisect.bisect_right(ends, s)].append(str(i))
        written = ";".join(",".join(x) + "|" + ",".join(y) for x, y in zip(*sides, strict=True))
        counts.update(links)
        found.append((doc_id, len(a), len(b), len(ends), links, hashlib.sha256(written.encode()).hexdigest() if ends else ""))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    for doc_id, n_a, n_b, n_groups, links, digest in found:
        yield doc_id, n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest


def overlaps(a, b):
    out, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            out.append((i, b[k][0]))
            k += 1
    return out


def test_alignment_equals_brute_force(docs, rows, none):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = list(brute_alignment(rows))
    for chunk_bytes in (alignment.CHUNK_BYTES, 2000):
        assert plain(alignment.groups(docs, chunk_bytes=chunk_bytes).select(*columns).collect()) == plain(want)
    assert {w[0]: w[1] for w in want}[951] == 0 and {w[0]: w[7] for w in want}[900] == ""
    assert alignment.groups(none).count() == 0


def test_cuts_of_texts_without_common_ends_and_with_many():
    draw = random.Random(3)
    for _ in range(200):
        a_end, b_end, a_of, b_of, at = [], [], [0], [0], 0
        for _ in range(draw.randrange(4)):
            n = draw.randrange(1, 40)
            a_end += sorted({at + draw.randrange(1, n + 1) for _ in range(draw.randrange(12))} | {at + n})
            b_end += sorted({at + draw.randrange(1, n + 1) for _ in range(draw.randrange(12))} | {at + n})
            at += n
            a_of.append(len(a_end))
            b_of.append(len(b_end))
        got = alignment.cuts(*(np.array(x, dtype=np.int64) for x in (a_end, b_end, a_of, b_of)))
        assert got.tolist() == [i for i, e in enumerate(a_end) if e in set(b_end)]


def brute_fingerprint(text):
    import xxhash

    w = words_of((text or "").translate(LOWER))
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """fps: (id, fingerprint); the smallest id reachable over at most three bits."""
    values = sorted({f for _, f in fps})
    part = {f: f for f in values}
    for i, f in enumerate(values):
        for g in values[:i]:
            if bin(f ^ g).count("1") <= 3 and part[f] != part[g]:
                old, new = part[f], part[g]
                part = {k: new if v == old else v for k, v in part.items()}
    least = {}
    for i, f in fps:
        if i is not None:
            least[part[f]] = min(i, least.get(part[f], i))
    return [(i, f"{f:016x}", least.get(part[f])) for i, f in fps]


def test_simhash_equals_brute_force(docs, rows, none):
    want = brute_components([(d[0], brute_fingerprint(d[1])) for d in rows])
    got = simhash.near(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert plain(got) == plain(want)
    assert simhash.near(none).count() == 0


def test_a_long_text_is_counted_in_steps(monkeypatch):
    import pyarrow as pa

    texts = [" ".join(f"w{i * i % 977}" for i in range(3000)), None, "two words", "w1 w2 w3 w4"]
    whole = simhash.text_fingerprints(pa.array(texts))
    monkeypatch.setattr(simhash, "STEP", 7)
    assert simhash.text_fingerprints(pa.array(texts)).tolist() == whole.tolist() == [brute_fingerprint(t) for t in texts]


def test_trie_meets_every_pair_once_and_crowded_subtrees_are_cut(spark):
    draw = random.Random(5)
    fps = {draw.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for f in [*fps]:
        for flips in (1, 2, 3, 3, 4):
            for b in draw.sample(range(64), flips):
                f ^= 1 << b
            fps.add(f)
    crowd = draw.getrandbits(64)  # a crowd that shares nearly all bits
    fps |= {crowd ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(0, 64, 9)}
    values = np.array(sorted(fps), dtype=np.uint64)
    got = [(i, j) for x, y in simhash.near_pairs(values, np.array([0]), np.array([len(values)]), 3) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
    want = {(i, j) for j in range(len(values)) for i in range(j) if (int(values[i]) ^ int(values[j])).bit_count() <= 3}
    assert len(got) == len(want) and {(min(p), max(p)) for p in got} == want
    rows = spark.createDataFrame([(int(v.astype(np.int64)),) for v in values], "fp long")
    parts = {c for _, _, c in brute_components([(i, int(v)) for i, v in enumerate(values)])}
    for group_rows in (simhash.GROUP_ROWS, 150):
        edges = simhash.links(simhash.subtrees(rows, group_rows)).collect()
        place = {int(v.astype(np.int64)): i for i, v in enumerate(values)}
        part = list(range(len(values)))
        for u, v in edges:
            old, new = part[place[u]], part[place[v]]
            part = [new if p == old else p for p in part]
        assert len(set(part)) == len(parts)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def cell(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    def path(tree, i):
        out = []
        for level in tree[:-1]:
            a = i // 16 * 16
            out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 16])))
            i //= 16
        return out

    by_source = {}
    for doc_id, text, lang, source, n_chars in rows:
        row = [cell(v) for v in (doc_id, source, lang, n_chars, text)]
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        altered = h(*row[:4], cell(text and text.translate(LOWER))) if bad else None
        by_source.setdefault(source, []).append((doc_id is not None, doc_id or 0, h(*row), altered))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    upper = levels([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for i, (known, doc_id, leaf, altered) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            way, now = path(trees[s], i) + path(upper, k), altered or leaf
            for left, right in way:
                now = h(left, now, right)
            root = upper[-1][0]
            yield doc_id if known else None, leaf, trees[s][-1][0], root, h(*(x for side in way for x in side)), now, now == root


def test_manifest_equals_brute_force(spark, docs, rows, none):
    assert plain(merkle.proofs(merkle.manifest(docs)).collect()) == plain(brute_manifest(rows))
    many = [(i, f"Text {i}", "en", "one" if i < 4100 else f"s{i % 37}" if i < 4200 else None, i) for i in range(4217)]
    got = merkle.proofs(merkle.manifest(frame(spark, many))).collect()
    assert plain(got) == plain(brute_manifest(many))
    one = [(1, "Alone", None, None, None)]
    assert plain(merkle.proofs(merkle.manifest(frame(spark, one))).collect()) == plain(brute_manifest(one))
    assert merkle.manifest(none).count() == 0


def test_equal_rows_are_spread_over_tasks(spark):
    same = frame(spark, [(None, None, None, "a", None)] * 500)
    numbered = merkle.numbered(merkle.leaves(same), "doc_id", "digest", "row")
    assert sorted(r["idx"] for r in numbered.collect()) == list(range(500))
    assert numbered.select(F.min("n")).first()[0] == 500


@pytest.mark.parametrize("salts", [1, 4])
def test_components_of_hubs_chains_and_cliques(spark, monkeypatch, salts):
    from strata.llm import components

    monkeypatch.setattr(components, "HUB_DEGREE", 5)
    monkeypatch.setattr(components, "SALTS", salts)
    draw = random.Random(2)
    edges = [(1000, i) for i in range(60)] + [(i, i + 1) for i in range(2000, 2020)] + [(a, b) for a in range(3000, 3012) for b in range(3000, a)]
    edges += [(draw.randrange(4000, 4200), draw.randrange(4000, 4200)) for _ in range(120)] + [(7, 7), (1000, 3), (3, 1000)]
    part = {n: n for e in edges if e[0] != e[1] for n in e}
    for u, v in edges * 2:
        if u != v and part[u] != part[v]:
            low, high = sorted((part[u], part[v]))
            part = {n: low if p == high else p for n, p in part.items()}
    rows = spark.createDataFrame(edges, "u long, v long")
    assert dict(map(tuple, components.components(rows).collect())) == part
    assert components.components(rows.limit(0)).count() == 0
