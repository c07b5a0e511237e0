"""Whole chain written layer by layer (bronze -> silver -> gold) equals the
lazily computed star."""

from conftest import SF_SMALL
from starloom.plans.star import GOLD, Star, export
from starloom.sources import layers as B


def _rows(df):
    return sorted(map(tuple, export(df).collect()), key=repr)


def test_build_all_matches_lazy_star(spark, tmp_dir):
    counts = B.build_all(spark, SF_SMALL, tmp_dir)
    star = Star(spark, SF_SMALL)
    assert set(counts) == {"bronze", "silver", "gold"}
    assert counts["silver"]["orders"] == star.silver_orders.count()
    for t in GOLD:
        assert counts["gold"][t] == getattr(star, t).count(), t
    for t in ["fact_pedidos", "fact_pedidos_itens", "dim_vendedor", "dim_data"]:
        written = B.read_table(spark, tmp_dir, "gold", t)
        assert _rows(written) == _rows(getattr(star, t)), t
    report = {r["table_name"]: r["rows"] for r in B.layer_counts(spark, tmp_dir, "gold", GOLD).collect()}
    assert report == counts["gold"]
