import __spark_entry__ as entry_point
from tastegrid.config import DOMAINS
from tastegrid.operators import network as N
from tastegrid.operators.encoding import Encoder, item_spec, user_spec
from tastegrid.plans import feature_build, recommend
from tastegrid.workload import adapters as A
from tastegrid.workload.oracle import ORACLE
from tastegrid.workload.queries import QUERIES


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert rows.columns == ["profile_id", "username", "items"]
    items = rows.first()["items"]
    assert [i["rank"] for i in items] == list(range(1, len(items) + 1)) and len(items) <= 200
    scores = [i["score"] for i in items]
    assert scores == sorted(scores, reverse=True)


def test_every_query_is_named_once_and_checked():
    queries, oracle = entry_point.queries(), entry_point.oracle_sql()
    assert set(oracle) <= set(queries)
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(queries)


def test_stored_state_serves_new_tables(spark, sf_dir, tmp_path):
    """Fit, store, load, score: the transform of training is the transform of scoring."""
    domain = DOMAINS["clip"]
    users, catalogue = A.users(spark, sf_dir), A.catalogue(spark, sf_dir)
    fitted = feature_build.fit_features(users, catalogue, domain, A.AS_OF_YEAR)
    fitted.user_encoder.save(spark, str(tmp_path / "u"))
    fitted.item_encoder.save(spark, str(tmp_path / "i"))
    features = feature_build.apply_features(
        users, catalogue,
        Encoder.load(spark, str(tmp_path / "u"), user_spec()),
        Encoder.load(spark, str(tmp_path / "i"), item_spec(domain)),
        domain, A.AS_OF_YEAR,
    )
    assert features.names == fitted.names
    a = {r.content_id: (r.idx, r.val) for r in fitted.items.collect()}
    b = {r.content_id: (r.idx, r.val) for r in features.items.collect()}
    assert a == b
    weights = N.init_weights(len(features.names), domain.network)
    info = recommend.item_info(
        features.items, catalogue, A.tags(spark, sf_dir), A.rules(spark))
    found = recommend.recommend(
        A.watch_log_dense(spark, sf_dir), features, weights, domain, info, n=5)
    rows = found.collect()
    assert rows and all(len(r["items"]) == 5 for r in rows)
    limited = feature_build.apply_features(
        users, catalogue, fitted.user_encoder, fitted.item_encoder, domain, A.AS_OF_YEAR,
        num_users=10, num_items=20)
    assert limited.users.count() == 10 and limited.items.count() == 20


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from tastegrid.session import checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)
