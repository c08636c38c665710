"""Operators over documents against brute force, with nulls, repeats, ties, long and empty texts."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from small import frame, make, plain, shingles, words_of
from small import LOWER

from pyspark.sql import functions as F
from strata.llm import jaccard, languages, mixing, packing, quality, substrings, suffix_tree


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_pieces_hold_every_id_once_and_fit(docs, rows, none):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter((d[0], tuple([*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 1])) for d in rows)
    cut = packing.pieces(docs, keep_ids=True).collect()
    texts, one = Counter(), {}
    for p in sorted(cut, key=lambda p: (p["start"], )):
        assert p["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in p["ids"]))
        if p["doc_tokens"] <= packing.CAPACITY:
            texts[p["doc_id"], tuple(p["ids"])] += 1
        else:
            one.setdefault(p["doc_id"], []).extend(p["ids"])
    assert texts + Counter((i, tuple(ids)) for i, ids in one.items()) == want
    packed = packing.pack(packing.pieces(docs, keep_ids=True), group_pieces=40)
    bins = {}
    for p in packed.collect():
        bins.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sum(map(len, bins.values())) == len(cut)
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == packing.CAPACITY or (len(r["ids"]) & (len(r["ids"]) - 1)) == 0
    assert packing.pack(packing.pieces(none)).count() == 0


def test_first_fit_takes_the_leftmost_bin():
    import numpy as np

    lengths = sorted(np.random.default_rng(1).integers(1, 100, 300).tolist(), reverse=True)
    bins, offsets = packing.first_fit(np.array(lengths), 100)
    room = []
    for length, b, offset in zip(lengths, bins, offsets):
        first = next((i for i, r in enumerate(room) if r >= length), len(room))
        if first == len(room):
            room.append(100)
        assert (b, offset) == (first, 100 - room[first])
        room[first] -= length


def test_mixture_meets_its_targets(docs, rows, none):
    got = mixing.taken(mixing.mixture(docs)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for d in rows:
        sizes[d[3]] += len(words_of(d[1]))
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight, left, share, target = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set(order), 1.5 * sum(sizes.values()), {}
    while True:
        level = share / sum(weight[s] for s in left)
        full = {s for s in left if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in left}
            break
        for s in full:
            target[s] = 2 * sizes[s]
            share -= target[s]
        left -= full
    assert {round(r["target"], 6) for r in got} == {round(t, 6) for t in target.values()}
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[round(r["target"], 6)] += r["taken"]
    assert all(abs(t - target) <= 1.01 for target, t in taken.items())
    assert plain(mixing.taken(mixing.mixture(docs.repartition(7))).collect()) == plain(got)  # reruns agree
    assert mixing.taken(mixing.mixture(none)).count() == 0


def test_mixed_documents_have_the_words_taken(docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len(words_of(r["text"])) for r in mixed.select("text").collect())
    assert words == mixing.taken(mixing.mixture(docs)).agg(F.sum("taken")).first()[0]


def repeats(rows, length):
    """Kept words per distinct document, in the operator's order."""
    seen, out = set(), {}
    for key in sorted(rows, key=lambda k: (k[0] is None, k[0] or 0, k[1])):
        if key in out:
            continue
        w = words_of(key[2])
        keep = [True] * len(w)
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            if window in seen:
                keep[i : i + length] = [False] * length
            seen.add(window)
        out[key] = " ".join(x for x, k in zip(w, keep) if k)
    return out


@pytest.mark.parametrize("crowded", [10_000, 2])
def test_repeated_passages_go(docs, none, crowded):
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").collect()
    want = repeats([tuple(r) for r in keyed], 20)
    got = substrings.deduplicate(docs, group_rows=9, crowded=crowded)
    assert got.columns[: len(docs.columns)] == docs.columns
    kept = Counter((r["doc_id"], r["n_words"], r["text"] or "") for r in got.collect())
    assert kept == Counter((k[0], len(words_of(k[2])), want[tuple(k)]) for k in keyed)
    assert sum(r["n_removed"] for r in got.select("n_removed").collect()) > 100
    assert got.filter("doc_id = 900 AND text IS NULL").count() == 1
    assert substrings.deduplicate(none).count() == 0


def linked(rows, length, percent):
    sets = [shingles(d[1], length) for d in rows]
    part = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]) and part[i] != part[j]:
                part = [part[j] if p == part[i] else p for p in part]
    least = {}
    for d, p, s in zip(rows, part, sets):
        least.setdefault(p if s else ("empty", id(d)), []).append(d[0])
    best = {p: min((i for i in ids if i is not None), default=None) for p, ids in least.items()}
    return [(d[0], len(s), best[p if s else ("empty", id(d))]) for d, p, s in zip(rows, part, sets)]


@pytest.mark.parametrize("long_list, block", [(32, 4096), (1, 8)])
def test_similar_documents_link(spark, docs, rows, none, long_list, block):
    got = jaccard.join(docs, 4, 85, long_list=long_list, block=block).select("doc_id", "n_shingles", "component_id").collect()
    assert plain(got) == plain(linked(rows, 4, 85))
    assert jaccard.join(none, 4, 85).count() == 0


def test_near_copies_link_whatever_their_number(spark):
    base = [f"t{i}" for i in range(150)]
    rows = []
    for i in range(120):
        text = base[:]
        for j in range(i % 4):
            text[(i * 37 + j * 50) % 150] = f"edit{i}-{j}"
        rows.append((i, " ".join(text), None, None, None))
    for long_list, block in ((32, 50), (1000, 50)):
        got = jaccard.join(frame(spark, rows, False), 4, 85, long_list=long_list, block=block)
        assert plain(got.select("doc_id", "n_shingles", "component_id").collect()) == plain(linked(rows, 4, 85))


def test_boundary_follows_the_cost():
    assert jaccard.boundary([(500, 1000)], 85) == 0  # nothing small to enumerate
    assert jaccard.boundary([(10, 5_000_000)], 85) >= 10  # lists are long, pairs are few
    assert jaccard.prefix(20, 85) == 4 and jaccard.prefix(20, 85, 2) == 5


def test_languages_are_told_apart(spark, docs, rows, none):
    english, german = "the house and the garden were with them that day ", "das haus und der garten waren nicht weit von dort "
    taught = [(i, english * 5 if i % 2 else german * 5, "en" if i % 2 else "de", None, 1) for i in range(20)]
    asked = [(100, english, None, None, 1), (101, german, None, None, 1), (102, None, "en", None, 1), (103, "12 !? \n", "en", None, 1), (104, german * 9 + english * 4, "en", None, 1)]
    model = languages.learn(frame(spark, taught))
    got = {r["doc_id"]: r for r in languages.identify(frame(spark, asked), model).collect()}
    assert [got[i]["lang_pred"] for i in range(100, 105)] == ["en", "de", "und", "und", "de"]
    assert got[100]["score"] == 1 and got[102]["score"] == 0
    assert 0.55 < got[104]["score"] < 0.85  # a mixture of both
    kept = languages.accepted(frame(spark, asked), model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [100, 101, 104]
    assert languages.identify(docs, model).count() == len(rows)
    empty = languages.learn(none)
    assert {r["lang_pred"] for r in languages.identify(docs, empty).collect()} == {"und"}
    assert languages.identify(none, model).count() == 0


def test_scores_are_chances_of_a_tree(docs, rows, none):
    train = F.coalesce(F.col("doc_id") % 5 != 0, F.lit(True))
    got = suffix_tree.score(docs, train, least_share=0.004, group_rows=16)
    tokens = [[w for w in words_of((d[1] or "").translate(LOWER))] + [None] for d in rows]
    counts = Counter(w for d, t in zip(rows, tokens) if d[0] is None or d[0] % 5 for w in t)
    total, kinds = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in t) for t in tokens]
    want = sorted((d[0] or -1, len(t), sum(counts[w] > 0 for w in t), total, round(b, 6)) for d, t, b in zip(rows, tokens, base))
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got.collect()) == want
    sums = got.agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]  # contexts help
    assert suffix_tree.score(none, F.lit(True)).count() == 0
    assert suffix_tree.score(docs, F.lit(False)).agg(F.max("n_known")).first()[0] == 0


def test_next_symbol_chances_add_up(spark):
    text = " ".join(["a b a b a c"] * 60)
    docs = frame(spark, [(1, text, None, None, None), (2, "b a c c", None, None, None)], False)
    levels, _, total, kinds = suffix_tree.learn(docs, 3, 10, 0.02, 0.01)
    kept = [r for level in levels for r in level.filter("kept").collect()]
    assert kept
    # the chances of all followers and what is left to the parent make one: by the context's sums alone
    texts = [text.split() + [None], "b a c c".split() + [None]]
    after = {d: Counter(tuple(t[i - d : i + 1]) for t in texts for i in range(d, len(t))) for d in (1, 2, 3)}
    sums = Counter()
    for d in after:
        held = {}
        for (*ctx, w), c in after[d].items():
            held.setdefault(tuple(ctx), []).append(c)
        sums.update((sum(cs), len(cs)) for cs in held.values())
    for r in kept:
        assert sums[r["total"], r["followers"]]
        assert r["total"] / (r["total"] + r["followers"]) + r["followers"] / (r["total"] + r["followers"]) == 1
    unknown = 0.1 / (total + 0.1 * (kinds + 1))
    one = Counter(w for t in texts for w in t)
    assert abs(sum((c + 0.1) / (total + 0.1 * (kinds + 1)) for c in one.values()) + unknown - 1) < 1e-9


def test_quality_needs_no_truth(spark, docs, rows, none):
    good = [(i, f"this is quite plain text number {i} with nothing odd in it at all and some more of it", None, None, None) for i in range(80)]
    bad = [(100 + i, "### *** " * 8 + f"&&& {i} !!! " * 5, None, None, None) for i in range(20)]
    toxic = [(200 + i, f"you stupid idiot number {i} are a pathetic loser said the moron", None, None, None) for i in range(15)]
    got = {r["doc_id"]: r for r in quality.classify(frame(spark, good + bad + toxic)).collect()}
    assert all(got[d[0]]["keep"] for d in good) and not any(got[d[0]]["keep"] for d in bad + toxic)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 1), (4, 1, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    scored = quality.classify(docs, labels)
    assert scored.count() == len(rows)
    assert not scored.filter("doc_id IN (900, 901, 902) AND keep").count()
    assert quality.classify(none, labels).count() == 0


def test_toxic_words_outside_the_list_are_learned(spark):
    plain_text = "the garden number {} was quiet and the house by the road stood open all day {}"
    clean = [(i, plain_text.format(i, i % 7), None, None, None) for i in range(400)]
    toxic = [(1000 + i, f"you zounderkite number {i} everyone thinks that a fopdoodle like you should go {i % 7}", None, None, None) for i in range(240)]
    marks = [(i, 1, 0) for i in range(100)] + [(1000 + i, 1, 1) for i in range(20)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(frame(spark, clean + toxic), labels).collect()}
    assert all(got[d[0]]["keep"] for d in clean)
    assert not any(got[d[0]]["keep"] for d in toxic)


def test_hashes_of_kept_words_agree(spark, rows):
    from strata.llm import queries

    text = "  two\t words \n"
    kept = substrings.deduplicate(frame(spark, [(1, text, None, None, 1)], False).select("doc_id", "text")).first()
    assert hashlib.sha256(kept["text"].encode()).hexdigest() == hashlib.sha256(b"two words").hexdigest()
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_em_equals_brute_force_and_finds_planted_rates():
    import numpy as np
    import pandas as pd

    draw = np.random.default_rng(1)
    true = draw.random(2000) < 0.3
    planted = np.array([[[0.05, 0.8, 0.15], [0.1, 0.6, 0.3], [0.02, 0.0, 0.98]], [[0.7, 0.1, 0.2], [0.6, 0.2, 0.2], [0.5, 0.0, 0.5]]])
    cast = np.stack([[draw.choice(3, p=planted[int(t), j]) for t in true] for j in range(3)], axis=1)
    votes = np.where(cast == 2, np.nan, (cast == 0).astype(float))
    for share in (0.0, 0.2):
        label = np.where(draw.random(len(true)) < share, true.astype(float), np.nan)
        names = ["poor_a", "poor_b", "poor_c", "poor_label"]
        table = pd.DataFrame(np.column_stack([votes, label]), columns=names)
        patterns = table.groupby(names, dropna=False).size().reset_index(name="n")
        prior, rate = quality.accuracies(patterns, names)
        assert abs(prior - true.mean()) < 0.05 and np.abs(rate - planted).max() < 0.12
        # the same, document by document
        p, r = 0.2, [[[x / sum(row) for x in row] for _ in range(3)] for row in quality.START.tolist()]
        for _ in range(200):
            post = []
            for c, y in zip(cast.tolist(), label.tolist()):
                yes, no = p, 1 - p
                for j, o in enumerate(c):
                    yes, no = yes * r[1][j][o], no * r[0][j][o]
                post.append(yes / (yes + no) if y != y else y)
            p = (sum(post) + 1) / (len(post) + 10)
            for row in (0, 1):
                for j in range(3):
                    told = list(quality.START[row])
                    for c, t in zip(cast[:, j].tolist(), post):
                        told[c] += t if row else 1 - t
                    r[row][j] = [x / sum(told) for x in told]
        assert abs(p - prior) < 1e-6 and np.abs(np.array(r) - rate).max() < 1e-6


def test_rare_contexts_are_candidates_at_any_corpus_size(spark):
    filler = [(i, " ".join(f"f{(i * 31 + j * j * 7) % 2003}" for j in range(400)), None, None, None) for i in range(60)]
    taught = [(1000 + i, "red green blue gold", None, None, None) for i in range(12)] + [(2000 + i, f"green blue x{i}", None, None, None) for i in range(12)]
    asked = [(3000, "red green blue gold", None, None, None), (3001, "green blue gold", None, None, None)]
    docs = frame(spark, filler + taught + asked, False)
    level = suffix_tree.learn(docs.filter("doc_id < 3000"), 3, 10, 0.0, 0.01).levels
    assert len(level) == 3 and all(x.filter("kept").count() for x in level)
    got = {r["doc_id"]: r for r in suffix_tree.score(docs, F.col("doc_id") < 3000, group_rows=16).filter("doc_id >= 3000").collect()}
    assert got[3000]["base_score"] < -12 and got[3000]["score"] - got[3000]["base_score"] > 6

    # the same by hand: counts, gains, retained contexts and back-off in plain Python
    texts = [[*words_of(d[1]), None] for d in filler + taught]
    total, kinds = sum(map(len, texts)), len({w for t in texts for w in t})
    one = Counter(w for t in texts for w in t)
    held, seen = {}, {d: Counter(tuple(t[i - d : i + 1]) for t in texts for i in range(d, len(t))) for d in (1, 2, 3)}

    def chance(ctx, w):
        if not ctx:
            return (one[w] + 0.1) / (total + 0.1 * (kinds + 1))
        if ctx not in held:
            return chance(ctx[1:], w)
        n, t, own = held[ctx]
        return (own.get(w, 0) + t * chance(ctx[1:], w)) / (n + t)

    for d in (1, 2, 3):
        after, kept = {}, {}
        for (*ctx, w), c in seen[d].items():
            after.setdefault(tuple(ctx), {})[w] = c
        for ctx, own in after.items():
            n, t = sum(own.values()), len(own)
            if n >= 10:
                gain = 0.0
                for w, c in own.items():
                    pp = chance(ctx[1:], w)
                    gain += c * math.log((c - 1 + t * pp) / (n - 1 + t) / pp)
                if gain > 0.01 * n:
                    kept[ctx] = (n, t, own)
        held |= kept
        assert level[d - 1].filter("kept").count() == len(kept)
    for i, text in asked_texts(asked):
        want = sum(math.log10(chance(tuple(text[max(0, j - 3) : j]), w)) for j, w in enumerate(text))
        assert abs(got[i]["score"] - want) < 1e-6


def test_crowded_words_are_dealt_without_a_change(spark, docs, rows):
    train = F.coalesce(F.col("doc_id") % 5 != 0, F.lit(True))
    columns = ("doc_id", "n_tokens", "n_known", "base_score", "score")
    whole, *dealt = (sorted(suffix_tree.score(docs, train, group_rows=16, crowded=n).select(*columns).collect(), key=str) for n in (1 << 20, 20, 300))
    for got in dealt:
        assert len(got) == len(whole) == len(rows)
        assert all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 and abs(a[4] - b[4]) < 1e-6 for a, b in zip(whole, got))
    one, many = (suffix_tree.learn(docs, 3, 10, 0.0, 0.01, crowded=n).levels for n in (1 << 20, 20))
    for a, b in zip(one, many):
        assert sorted(a.collect()) == sorted(b.collect())


def test_places_of_texts_travel_in_a_few_bytes(spark):
    """Each text is split once and each place goes to one part, once."""
    text = [" ".join(f"w{(i * 31 + j * j * 7) % 977}" for j in range(500)) for i in range(80)]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(text)], False)
    all_ = suffix_tree.corpus(docs, F.lit(True), 3, 10, 0.0, 8192, 1 << 24, 1 << 20)
    sent = suffix_tree.places(all_.slices, crowded_only=False, **all_.how).drop("part", "slice").collect()
    assert sum(len(suffix_tree.unpacked(r["w"], "u4")) for r in sent) == 80 * 500  # the end counts as a token, the first word has none before it
    assert sum(len(v) for r in sent for v in r) < 10 * 80 * 500


def asked_texts(rows):
    return [(d[0], [*words_of(d[1]), None]) for d in rows]
