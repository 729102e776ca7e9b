import random
import tracemalloc
from array import array

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loamline.llm import decontaminate as d
from loamline.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.fixtures import LONG, awkward, prose
from tests.oracle import compare, connect

ITEMS = [(1, prose(1, 40)), (2, prose(2, 13)), (3, "short item of six whole words"), (4, None), (5, ""), (6, prose(1, 40)), (None, prose(9, 20)), (7, "é"), (1, prose(1, 40)), (8, "the the the the the the the the the the the the the the")]


def docs():
    passage, other = prose(1, 40).split(), prose(2, 13).split()
    return [(1, " ".join(prose(5, 20).split() + passage[5:30] + prose(6, 30).split())), (2, prose(7, 500) + " " + " ".join(other).upper().replace(" ", ", ")), (3, "A Short--item, of SIX whole words!"), (4, None), (5, ""), (6, prose(8, 100)), (7, "é É e"), (8, "the " * 40), (9, " ".join(passage[:12])), (10, LONG)]


def frames(spark):
    return spark.createDataFrame(docs(), "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")


def rows(df):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()}


def test_equals_brute_force(spark):
    documents, items = frames(spark)
    want = d.brute_force(docs(), [x for x in ITEMS if x[0] is not None])
    assert rows(d.report(d.contamination(documents, items))) == want


def test_several_passes_find_the_same(spark):
    documents, items = frames(spark)
    want = rows(d.report(d.contamination(documents, items)))
    assert rows(d.report(d.contamination(documents, items, pass_bytes=150))) == want


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    compare(connect(folder), QUERIES["op5_decontaminate"](spark, folder), ORACLE_SQL["op5_decontaminate"])


def test_awkward_rows_and_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    found = d.report(d.contamination(awkward(spark), items)).collect()
    assert len(found) == 10 and not any(r["contaminated"] for r in found)
    assert {r["n_words"] for r in found if r["doc_id"] in (2, 3, 6)} == {0}
    assert d.contamination(awkward(spark, []), frames(spark)[1]).count() == 0


def test_filter_drops_contaminated_rows_only(spark):
    documents = awkward(spark, docs())
    kept = d.drop_contaminated(documents, frames(spark)[1])
    want = d.brute_force(docs(), [x for x in ITEMS if x[0] is not None])
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, w in want.items() if not w[4])


def test_filter_in_several_passes(spark):
    documents = awkward(spark, [*docs(), *docs(), (None, docs()[0][1]), (None, None)])
    want = sorted((r["doc_id"] or -1) for r in d.drop_contaminated(documents, frames(spark)[1]).collect())
    assert sorted((r["doc_id"] or -1) for r in d.drop_contaminated(documents, frames(spark)[1], pass_bytes=150).collect()) == want and want.count(6) == 2


def test_one_pass_takes_no_shuffle_of_documents(spark):
    plan = d.contamination(*frames(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_tables_of_a_pass_are_bounded():
    """The tables take no more than 60 times the text, so those of PASS_BYTES fit a worker."""
    rng = random.Random(1)
    items = [(str(i), prose(rng.randint(0, 10**9), 60).encode()) for i in range(2000)]
    tracemalloc.start()
    searcher = d.Searcher(items)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(searcher.items) == 2000 and held < 60 * sum(len(t) for _, t in items)
    assert 60 * d.PASS_BYTES < 400 << 20


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 300), st.integers(1, 300)), max_size=6))
def test_merged_ranges(spark, pairs):
    spans = [(min(p), max(p) + 1) for p in pairs]
    want: list = []
    for a, b in sorted(spans):
        if want and a <= want[-1][1]:
            want[-1] = (want[-1][0], max(b, want[-1][1]))
        else:
            want.append((a, b))
    df = spark.createDataFrame([(spans,)], "spans array<struct<start:bigint,end:bigint>>")
    assert [tuple(x) for x in df.select(d.merged(df["spans"]).alias("m")).first()["m"]] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), min_size=1, max_size=4), st.lists(st.sampled_from("abcd"), max_size=40))
def test_search_equals_scanning(items, words):
    size = min(map(len, items))
    number, flat, ranges = {}, array("I"), []
    for item in items:
        ranges.append((len(flat), len(item)))
        flat.extend(number.setdefault(w, len(number) + 1) for w in item)
    windows = {at: item[i : i + size] for (start, n), item in zip(ranges, items, strict=True) for i, at in enumerate(range(start, start + n - size + 1))}
    want = sorted((i, at) for i in range(len(words) - size + 1) for at, w in windows.items() if words[i : i + size] == w)
    assert sorted(d.WuManber(flat, ranges, size).occurrences(words, number)) == want
