from tradeflow.operators.snapshots import read_train_test, read_version
from tradeflow.plans import fixtures as fx
from tradeflow.plans.medallion import run_medallion
from tradeflow.schemas import TARGET

SF = "/root/testdata/sf0.001"


def test_all_layers(spark, tmp_path):
    folder = str(tmp_path)
    layers = run_medallion(spark, fx.dirty_trades(spark, SF), fx.bars(spark, SF), folder)
    assert tuple(layers.flags.first()) == (1, 1, 1)
    assert layers.silver.count() == layers.gold.count() > 0
    assert layers.report.filter("rule = 'valid_price' AND failed > 0").count() == 1
    labelled = read_version(spark, f"{folder}/trade_features")
    train, test = read_train_test(spark, folder, layers.versions)
    assert train.count() + test.count() == labelled.count() and TARGET in test.columns
    assert test.count() == -(-labelled.count() // 5)
    assert train.select("trade_id").intersect(test.select("trade_id")).count() == 0
