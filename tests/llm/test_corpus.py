"""The corpus operators against brute force, round trips and held-out accuracy, and on awkward rows."""

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from comparison import connect, differences
from siltstone.llm import chat_format, embedding_dedup, license_scan, line_dedup, mixing, packing
from siltstone.llm.exact_dedup import drop_copies, exact_groups, grow_directory
from siltstone.llm.jaccard_join import jaccard_components, least_overlap, subset_keys
from siltstone.llm.language_id import identify_languages
from siltstone.llm.queries import ORACLE_SQL, QUERIES
from siltstone.llm.shared import components
from siltstone.llm.toxicity import score_toxicity

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, rep int, __key int"
LONG = " ".join(f"word{n % 997}" for n in range(30_000))
ROWS = [
    (1, "The same text of some words here", "en", "a", 1, "x", 1, 1),
    (2, "the SAME text of some words here", "en", "a", 1, "x", 1, 1),
    (2, "the SAME text of some words here", "en", "a", 1, "x", 1, 1),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, None, None, None),
    (5, "   \n\t ", "fr", None, 0, None, None, None),
    (None, "no id but words enough to count", "en", "b", 0, None, None, None),
    (None, "The same text of some words here", None, "a", 0, None, None, None),
    (6, LONG, "en", "c", 0, None, None, None),
    (7, LONG + " end", "en", "c", 0, None, None, None),
    (8, "12 34 !!", "en", "c", 0, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    engine = connect(SF_DIR)
    for view in ("documents", "benchmark"):
        engine.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF_DIR}/{view}.parquet')")
    assert differences(QUERIES[name](spark, SF_DIR), engine, ORACLE_SQL[name]) == []


def brute_components(rows, words, percent):
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        runs = [tuple(w[k : k + words]) for k in range(len(w) - words + 1)]
        sets[doc] = set(runs) if runs else ({tuple(w)} if w else set())
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_jaccard_join_equals_brute_force(documents, spark, words, percent):
    small = [(1000 + n, " ".join("abcdefghijklmnopq"[: 5 + n // 3]) + " x" * (n % 3)) for n in range(30)]
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()] + small
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, words, percent)


def test_sets_share_a_subset_key_exactly_if_similar():
    values = np.arange(40, dtype=np.uint64)
    for a, b, shared in itertools.product(range(1, 10), range(1, 10), range(1, 10)):
        if shared <= min(a, b):
            one, two = values[:a], np.concatenate([values[:shared], values[20 : 20 + b - shared]])
            keys = [{(k, s) for k, s in subset_keys(np.sort(x), 85, 16)} for x in (one, two)]
            meets = any(
                k == l and {s, t} in ({0, 1}, {2}) for k, s in keys[0] for l, t in keys[1]
            )
            assert meets == (shared >= least_overlap(a, b, 85))


def test_components_of_a_path_and_a_star(spark):
    links = [(n, n + 1) for n in range(20, 40)] + [(5, n) for n in range(100, 130)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{n: 20 for n in range(20, 41)}, 5: 5, **{n: 5 for n in range(100, 130)}}


def test_exact_dedup_of_odd_rows(odd):
    found = sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in exact_groups(odd, capacity=1).collect())
    assert found == [
        (0, 0, 1, True), (0, 2, 4, False), (1, 2, 4, False), (2, 2, 4, False), (2, 2, 4, True),
        (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True), (7, 7, 1, True), (8, 8, 1, True),
    ]
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 4, 5, 6, 7, 8]


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    keys = spark.range(500).selectExpr("xxhash64(id) AS key")
    directory, depth = grow_directory(keys, capacity=4)
    slots = {r.slot: r.bucket for r in directory.collect()}
    assert max(slots) < 1 << depth
    shift = 64 - depth
    load = Counter(slots[(r.key % (1 << 64)) >> shift] for r in keys.collect())
    assert max(load.values()) <= 4 and sum(load.values()) == 500


def test_pieces_cover_documents_and_sequences(spark, documents, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_tokenizer())
    for docs in (documents, odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        ids = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
        places, filled = defaultdict(list), defaultdict(list)
        for r in packing.pack_documents(docs).collect():
            part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
            assert (zlib.crc32(part.tobytes()), len(part), len(ids[r.doc_id])) == (r.ids_crc32, r.length, r.doc_tokens)
            places[r.doc_id].append((r.start, r.length))
            filled[r.sequence_id].append((r.offset, r.length))
        for spans, end in [(places[d], len(ids[d])) for d in ids] + [(s, None) for s in filled.values()]:
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert at == end if end is not None else at <= 2048
    total = sum(map(len, ids.values()))
    assert len(filled) <= -(-total // 2048) + 8


def test_words_encode_like_the_library():
    from tokenizers import Tokenizer

    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        definition = file.read()
    library, encoder = Tokenizer.from_str(definition), packing.Encoder(definition)
    rng = np.random.default_rng(1)
    letters = list("ab 'sé1_-\n\t\xa0\xad²ßªº\x0b\x1f<|>endoftext.,ǘ")
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 14)))
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_differencing_raises_the_number_of_windows():
    sets = packing.pack_pieces([6, 6, 6, 5, 5], 10)
    assert sorted(i for s in sets for i in s) == list(range(5)) and len(sets) == 4


def brute_targets(sizes, weights=(5, 2, 1)):
    weight = {s: weights[n % 3] for n, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = left / max(1e-9, sum(weight[s] for s in sizes if s not in full))
        over = {s for s in sizes if s not in full and weight[s] * share > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * share for s in sizes}
        full |= over


def test_mix_meets_targets(spark, documents, odd):
    for docs in (documents, odd):
        rows = {}
        for r in docs.collect():
            rows.setdefault(r.source, []).append(len((r.text or "").encode().split()))
        targets = brute_targets({s: sum(v) for s, v in rows.items()})
        found = mixing._taken(docs).join(
            docs.selectExpr("xxhash64(doc_id, text) AS hash", "source").distinct(), "hash"
        ).collect()
        taken = Counter()
        for r in found:
            assert 0 <= r.taken <= 3 * r.size and r.target == pytest.approx(targets[r.source])
            taken[r.source] += r.taken
        for source, target in targets.items():
            assert abs(taken[source] - target) <= 0.01 * target + 48
    again = [sorted(map(str, mixing.mix_sources(documents).collect())) for _ in range(2)]
    assert again[0] == again[1]


def test_sainte_lague_equals_highest_quotients(spark):
    rng = np.random.default_rng(3)
    for seats in (1, 7, 50):
        sizes = [int(x) for x in rng.integers(1, 200, 12)]
        frame = spark.createDataFrame(
            [(0, n, s, seats, 1000) for n, s in enumerate(sizes)], "g int, n int, size long, seats long, most long"
        )
        found = {r.n: r.quota for r in mixing.apportion(frame, ["g"], ["n"], "seats", "size", "most").collect()}
        quotients = sorted((-s / (2 * k + 1), n) for n, s in enumerate(sizes) for k in range(seats))
        assert found == {**dict.fromkeys(range(12), 0), **Counter(n for _, n in quotients[:seats])}


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    near = base[:20] + 0.05 * rng.normal(size=(20, 16))
    vectors = [v.tolist() for v in [*base, *near, base[0]]]
    rows = [(n, v, n % 80 % 60 % 3) for n, v in enumerate(vectors)]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, vectors[0], None), (204, [], 0)]
    found = embedding_dedup.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    links = Counter()
    for a, b in itertools.combinations(rows[:81], 2):
        x, y = np.array(a[1]), np.array(b[1])
        if a[2] == b[2] and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
            links.update([a[0], b[0]])
    found = {r.vec_id: r for r in found.collect()}
    assert {n: found[n].n_links for n in found if found[n].n_links} == dict(links)
    assert found[80].component_id == found[60].component_id == 0 and not found[60].kept
    assert all(found[n].kept and found[n].component_id == n for n in (200, 201, 202, 203, 204))


def test_language_on_held_out_documents(documents, odd):
    rows = identify_languages(documents).where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    found = {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(odd).where("doc_id IN (3, 4, 5, 8)").collect()}
    assert found == dict.fromkeys((3, 4, 5, 8), ("und", 0.0))


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = score_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_recurring_lines_go_and_others_stay(spark):
    own = [f"own words {chr(97 + n)}{chr(97 + m)} of a line" for n in range(4) for m in range(5)]
    rows = [(n, f"{line} alone\nVisit page {n} of 77 for our newest offers today\n\nend{line}") for n, line in enumerate(own)]
    rows += [(100 + n, "copies of one text\nthat all are equal") for n in range(30)] + [(200, None)]
    found = {r.doc_id: r for r in line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()}
    assert all(found[n].n_dropped >= 1 and "offers" not in found[n].text for n in range(20))
    assert all(found[n].n_dropped == 0 for n in range(100, 130)) and found[200].text is None


def test_roles_by_blocks_equal_one_run(spark, monkeypatch):
    rng = np.random.default_rng(2)
    model = chat_format.RoleModel(*[chat_format._log_share(rng.random(s)) for s in ((3,), (3, 3), (3, 4), (3, 8), (3, 2), (3, 2))])
    texts = ["words " * int(rng.integers(1, 90)) + "?" * int(rng.integers(0, 2)) for _ in range(300)]
    rows = [(1, n, t) for n, t in enumerate(texts)] + [(2, 0, "User: hi\nAssistant: hello"), (None, None, None)]
    found = chat_format.recover_roles(spark.createDataFrame(rows, "conv_id long, turn long, text string"), model)
    by_turn = {r.turn: r.role_pred for r in found.where("conv_id = 1").collect()}
    scores = np.array([model.emission(*chat_format.features(*chat_format.segments(t)[0])) for t in texts])
    assert [by_turn[n] for n in range(300)] == [chat_format.ROLES[k] for k in chat_format.best_path(model.first, scores, model.following)]
    assert [r.text for r in found.where("conv_id = 2").orderBy("segment").collect()] == ["hi", "hello"]


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, gpl = license_scan.TEMPLATES["MIT"][0], license_scan.TEMPLATES["GPL-3.0"][0]
    rows = [
        ("/r/LICENSE", mit), ("/r/a/b/x.py", "plain words here"), ("/r/c/COPYING", gpl), ("/r/c/d/y.py", "other things"),
        ("/r/c/z.py", f"{mit}\nsome code"), ("/q/x.py", "nothing stated"), (None, None),
    ]
    found = {r.path: r for r in license_scan.scan_licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert (found["/r/a/b/x.py"].licence, found["/r/a/b/x.py"].inherited_from) == ("MIT", "/r")
    assert (found["/r/c/d/y.py"].licence, found["/r/c/d/y.py"].inherited_from) == ("GPL-3.0", "/r/c")
    assert found["/r/c/z.py"].licence == "MIT" and found["/q/x.py"].licence is None and found[None].licence is None


def test_pipeline_keeps_columns_and_takes_odd_and_empty_tables(spark, odd):
    for docs in (odd, odd.limit(0)):
        for _, apply in corpus_pipeline.STAGES[:-1]:
            docs_out = apply(spark, docs, SF_DIR)
            assert docs_out.columns == docs.columns
            docs_out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()


def test_empty_tables_give_no_rows(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    results = [
        exact_groups(none), mixing.mix_sources(none), jaccard_components(none), identify_languages(none),
        score_toxicity(none, labels), line_dedup.drop_recurring_lines(none), packing.pack_documents(none),
        chat_format.recover_roles(turns), embedding_dedup.embedding_components(vectors),
        license_scan.scan_licences(none.selectExpr("source AS path", "text")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_a_licence_held_by_a_third_of_all_files_is_found_wrapped_and_inside_lines(spark):
    rng = np.random.default_rng(4)
    mpl, gpl2 = license_scan.TEMPLATES["MPL-2.0"][0], license_scan.TEMPLATES["GPL-2.0"][1]
    words = mpl.split()
    rows = []
    for n in range(300):
        own = " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(40)) + " the of this and is to"
        wrapped = "\n".join(" * " + " ".join(words[k : k + 4]) for k in range(0, len(words), 4))
        head = [f"/*\n{wrapped}\n */", "", ""][n % 3]
        rows.append((f"/r{n}/x{n}", f"{head}\n{own}" if n % 50 != 1 else f"{own} {gpl2} {own}"))
    found = license_scan.scan_licences(spark.createDataFrame(rows, "path string, text string")).collect()
    want = {f"/r{n}/x{n}": "GPL-2.0" if n % 50 == 1 else [("MPL-2.0"), None, None][n % 3] for n in range(300)}
    assert {r.path: r.own_licence for r in found} == want


def test_licence_query_inherits_over_several_levels_like_brute_force(spark):
    rows = [r.asDict() for r in QUERIES["op1_license_scan"](spark, "/root/testdata/sf0.1").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    assert len(rows) == len(texts) and {len(r["path"].split("/")) for r in rows} == {3, 4, 5, 6, 7}
    licensed = {}
    for r in rows:
        directory, name = r["path"].rsplit("/", 1)
        if r["licence_file"]:
            order = (not name.startswith("LICENSE"), -round(r["cosine"], 6), r["own_licence"])
            licensed[directory] = min(licensed.get(directory, order), order)
        else:
            assert not (r["own_licence"] and name.startswith("LICENSE"))
        assert r["own_licence"] is None or "licen" in texts[r["doc_id"]].lower() or "rights reserved" in texts[r["doc_id"]]
    levels = Counter()
    for r in rows:
        above = r["path"].rsplit("/", 1)[0]
        own = above
        while above and above not in licensed:
            above = above.rpartition("/")[0]
        want = (r["own_licence"], None) if r["own_licence"] else (licensed[above][2], above) if above else (None, None)
        assert (r["licence"], r["inherited_from"]) == want
        if want[1]:
            levels[own.count("/") - above.count("/")] += 1
    assert sum(levels.values()) >= 1000 and len(levels) >= 3 and sum(n for k, n in levels.items() if k) >= 500


def test_toxicity_learns_pairs_of_words_that_tell_nothing_alone(spark):
    rng = np.random.default_rng(6)
    docs, labels = [], []
    for n in range(2500):
        group, verb = rng.integers(0, 2, 2)
        words = [f"f{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in rng.integers(0, 300, 20)]
        words += [f"{'xy'[group]}group{'abc'[rng.integers(3)]}", f"{'uv'[verb]}verb{'abc'[rng.integers(3)]}"]
        docs.append((n, " ".join(rng.permutation(words))))
        labels.append((n, int(group == verb)))
    found = score_toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    toxic = dict(labels)
    assert np.mean([r.predicted == toxic[r.doc_id] for r in found.where("held_out").collect()]) > 0.95


def test_templates_of_a_hot_leaf_meet_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CHUNK_LINES", 40)
    rng = np.random.default_rng(8)
    seen = spark.sparkContext.accumulator(0)
    grow = line_dedup.grow_templates

    def bounded(lines, starts=()):
        seen.add(len(lines) > 160)
        return grow(lines, starts)

    monkeypatch.setattr(line_dedup, "grow_templates", bounded)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    # one leaf: three numbers, then words that differ in nearly every row; and one notice with a word that varies
    rows = [(n, "\n".join(f"{n} {k} 7 " + " ".join(word() for _ in range(7)) for k in range(10))) for n in range(100)]
    rows += [(1000 + n, f"1 2 3 see our newest offers {word()} today here") for n in range(30)]
    found = {r.doc_id: r for r in line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()}
    assert all(found[n].n_dropped == 0 for n in range(100))
    assert all(found[1000 + n].text == "" for n in range(30))
    assert seen.value == 0


def test_a_question_before_long_code_is_asked():
    code = "\n".join(f"value_{n} = {n}" for n in range(100))
    assert chat_format.features(0, f"Why does this fail?\n{code}")[2] == 1
    assert chat_format.features(0, code)[2] == 0


def test_texts_are_grouped_after_the_directory_is_asked(spark, odd, monkeypatch):
    from siltstone.llm import exact_dedup

    staged, stage = [], exact_dedup.stage
    monkeypatch.setattr(exact_dedup, "stage", lambda frame, name: staged.append(name) or stage(frame, name))
    index = exact_dedup.build_index(odd, 1)[0].collect()
    assert "texts" not in staged and staged.index("directory") < staged.index("index")
    assert len({r.bucket for r in index}) == len(index) and sum(r.group_size for r in index) == odd.count()
