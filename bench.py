"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Every query is run once to warm up and then BENCH_RUNS times; the median counts. Results are
consumed by a full write to Spark's no-op sink, so nothing is pruned away or collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tradeflow.plans.catalog import QUERIES
from tradeflow.session import local_session

HEADLINE = [
    "silver_enrich",
    "gold_features",
    "gold_features_ema",
    "gold_many_symbols",
    "gold_tied_times",
    "time_range_features",
    "anomaly_rate",
    "asof_features",
    "stratified_split",
    "drift_report",
    "pr_auc_lines",
    "inference_30m",
    "decode_ticks",
    "retrain_decision",
    "stream_silver",
    "stream_gold",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _feature_block(trades):
    """The rolling feature block as a single-node per-symbol pandas loop."""
    import numpy as np
    import pandas as pd

    parts = []
    for _, one in trades.sort_values(["symbol", "ts"]).groupby("symbol"):
        p, v = one["p"], one["v"]
        roll_p, roll_v = p.rolling(14, min_periods=1), v.rolling(14, min_periods=1)
        move = p.diff().fillna(0.0)
        gain = move.clip(lower=0).rolling(14, min_periods=1).mean()
        loss = (-move).clip(lower=0).rolling(14, min_periods=1).mean()
        vwap = (p * v).rolling(14, min_periods=1).sum() / roll_v.sum().replace(0, np.nan)
        std = roll_p.std()
        parts.append(
            one.assign(
                pct=p.pct_change() * 100,
                z=(v - roll_v.mean()) / roll_v.std(),
                vol=std,
                dev=(p - vwap) / vwap * 100,
                rsi=100 - 100 / (1 + gain / loss.replace(0, np.nan)),
                macd=p.ewm(span=12, adjust=False).mean() - p.ewm(span=26, adjust=False).mean(),
                boll=(p - (roll_p.mean() - 2 * std)) / (4 * std),
                spread=std / p * 100,
            )
        )
    return pd.concat(parts)


def _pandas_trades(sf_dir):
    import pandas as pd

    events = pd.read_parquet(f"{sf_dir}/events.parquet")
    k = events["props"].str.extract(r"(\d+)", expand=False).astype(int)
    user = "U" + events["user_id"].astype(str)
    return pd.DataFrame(
        {"symbol": events["event_type"].str.upper(), "user": user, "ts": events["ts"], "p": events["value"], "v": 2.0 * k * k}
    )


def single_node(sf_dir: str) -> dict[str, float]:
    """Seconds of the same work in pandas and numpy, reading included."""
    import numpy as np
    import pandas as pd

    def timed(work) -> float:
        started = time.monotonic()
        work()
        return round(time.monotonic() - started, 3)

    def many():
        trades = _pandas_trades(sf_dir)
        _feature_block(trades.assign(symbol=trades["user"]))

    def tied():
        lines = pd.read_parquet(f"{sf_dir}/lineitem.parquet")
        lines["id"] = lines["l_orderkey"].astype(str) + "-" + lines["l_linenumber"].astype(str)
        lines = lines.sort_values(["id", "l_shipdate"]).drop_duplicates("id")
        names = {"l_suppkey": "symbol", "l_shipdate": "ts", "l_extendedprice": "p", "l_quantity": "v"}
        _feature_block(lines.rename(columns=names)[list(names.values())])

    def ewm():
        for _, one in _pandas_trades(sf_dir).sort_values(["symbol", "ts"]).groupby("symbol"):
            one["p"].ewm(span=12, adjust=False).mean() - one["p"].ewm(span=26, adjust=False).mean()

    def drift():
        trades = _pandas_trades(sf_dir)
        newest = trades["ts"].max()
        current = trades["ts"] > newest - pd.Timedelta(days=1)
        columns = {"p": trades["p"], "v": trades["v"], "h": trades["ts"].dt.hour, "m": trades["ts"].dt.minute}
        for column in columns.values():
            r, c = column[~current].to_numpy(), column[current].to_numpy()
            edges = np.unique(np.percentile(r, np.linspace(0, 100, 11)))
            a = (np.histogram(r, edges)[0] + 1) / (len(r) + len(edges))
            b = (np.histogram(c, edges)[0] + 1) / (len(c) + len(edges))
            ((b - a) * np.log(b / a)).sum()

    return {
        "gold_features": timed(lambda: _feature_block(_pandas_trades(sf_dir))),
        "gold_many_symbols": timed(many),
        "gold_tied_times": timed(tied),
        "ewm_only": timed(ewm),
        "drift_numeric": timed(drift),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        times = []
        for turn in range(runs + 1):
            started = time.monotonic()
            consume(QUERIES[name](spark, sf_dir))
            if turn:
                times.append(time.monotonic() - started)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "single_node_pandas": single_node(sf_dir),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
