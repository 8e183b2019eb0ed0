import pytest

from recallset import ConfigurationError, IndexSpec, StoreSpec, UnsupportedFilterError, ValidationError
from recallset.spec import check_search_bounds


@pytest.mark.parametrize(
    "options, named",
    [
        ({"dimensions": 0}, "dimensions"),
        ({"dimensions": 2.5}, "dimensions"),
        ({"document_type": ""}, "document_type"),
        ({"key_prefix": ""}, "key_prefix"),
        ({"filter_fields": ["a", "a"]}, "filter_fields"),
        ({"filter_fields": ["a", ""]}, "filter_fields"),
        ({"filter_fields": {"a": "date"}}, "filter_fields"),
        ({"index_name": "1bad"}, "index_name"),
        ({"index_name": "bad-name"}, "index_name"),
        ({"rerank": True}, "rerank"),
        ({"n_probes": 2, "top_n_scan": 5}, "top_n_scan"),
        ({"n_probes": 0}, "n_probes"),
        ({"n_probes": 2, "rerank": True, "top_n_scan": 0}, "top_n_scan"),
        ({"key_buckets": 0}, "key_buckets"),
        ({"search_scope": "all"}, "search_scope"),
    ],
)
def test_store_options_are_checked(options, named):
    with pytest.raises(ConfigurationError, match=named):
        StoreSpec(**{"dimensions": 2, **options})


@pytest.mark.parametrize(
    "options, named",
    [
        ({"index_name": "9"}, "index_name"),
        ({"description": ""}, "description"),
        ({"description": "HNSW"}, "description"),
        ({"description": "IVF0,SQ8"}, "description"),
        ({"scan_n_probes": 0}, "scan_n_probes"),
        ({"train_list": 0}, "train_list"),
        ({"train_list": 1_000_001}, "train_list"),
        ({"persist_full_vector": 1}, "persist_full_vector"),
    ],
)
def test_index_options_are_checked(options, named):
    with pytest.raises(ConfigurationError, match=named):
        IndexSpec(StoreSpec(2), **options)


def test_rerank_needs_full_vectors():
    store = StoreSpec(2, n_probes=1, rerank=True)
    with pytest.raises(ConfigurationError, match="must remain enabled"):
        IndexSpec(store, persist_full_vector=False)
    assert IndexSpec(StoreSpec(2), persist_full_vector=False).persist_full_vector is False


def test_index_names_and_lists():
    spec = IndexSpec(StoreSpec(2), index_name="a#1_b", description="IVF32,SQ8", train_list=1_000_000)
    assert spec.requested_lists == 32
    assert IndexSpec(StoreSpec(2)).requested_lists is None


@pytest.mark.parametrize("limit", [0, -1, 1.5, True, "3"])
def test_limit_must_be_a_positive_integer(limit):
    with pytest.raises(ValidationError, match="positive integer"):
        check_search_bounds(limit, 0)


@pytest.mark.parametrize("threshold", [-0.1, 2, float("nan"), float("inf"), "1"])
def test_threshold_must_be_between_0_and_1(threshold):
    with pytest.raises(ValidationError, match="between 0 and 1"):
        check_search_bounds(1, threshold)


@pytest.mark.parametrize(
    "filters, message",
    [
        ({"other": "x"}, "is not among"),
        ({"userId": ["x"]}, "finite number"),
        ({"userId": None}, "finite number"),
        ({"userId": float("nan")}, "finite number"),
    ],
)
def test_filters_are_checked_before_any_job(filters, message):
    with pytest.raises(UnsupportedFilterError, match=message):
        StoreSpec(2).check_filter(filters)
