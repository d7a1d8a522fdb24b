"""All registered queries and their SQL."""

from __future__ import annotations

from barlight.plans import feature_queries, market_queries, option_queries, reference_queries, scan_queries, single_queries, stream_queries, trade_queries, window_queries

PARTS = (market_queries, reference_queries, feature_queries, window_queries, option_queries, trade_queries, stream_queries, scan_queries, single_queries)
QUERIES = {name: fn for part in PARTS for name, fn in part.BOOK.queries.items()}
ORACLE_SQL = {name: text for part in PARTS for name, text in part.BOOK.sql.items()}

#: Operators whose columns another query computes along with its own: that query, and the operator's columns.
VIEWS = {
    "daily_bar_features": ("daily_features", "ticker day n_bars dollar_volume total_volume range_pct last_close first_range"),
    "score_quotes": ("score_liquidity", "ticker day score_quotes"),
    "score_volatility": ("score_liquidity", "ticker day score_volatility"),
    "score_options": ("score_orderflow", "ticker day score_options"),
    "to_int": ("to_number", "event_id n"),
    "bar_number": ("returns", "ticker ts bar_no"),
    "log_returns": ("returns", "ticker ts log_ret"),
    "bar_range": ("returns", "ticker ts bar_range"),
    "true_range": ("atr", "ticker ts true_range"),
    "volume_ma": ("rel_vol", "ticker ts volume_ma"),
    "return_stdev": ("rel_vol", "ticker ts return_stdev"),
    "vwap_dist_pct": ("session_vwap", "ticker ts vwap_dist_pct"),
    "local_atr": ("rolling_vwap", "ticker ts local_atr"),
    "prior_high": ("rolling_vwap", "ticker ts prior_high"),
    "prior_low": ("rolling_vwap", "ticker ts prior_low"),
    "prior_avg_volume": ("rolling_vwap", "ticker ts prior_avg_volume"),
    "price_move": ("rolling_vwap", "ticker ts price_move"),
    "volume_spike": ("rolling_vwap", "ticker ts volume_spike"),
    "running_pnl": ("equity_curve", "ticker day running_pnl"),
    "drawdown": ("equity_curve", "ticker day drawdown"),
    "chain_features": ("option_features", "ticker ts contract_count straddle expected_move pcr"),
}


def _columns(base: str, columns: list[str]):
    return lambda spark, sf_dir: QUERIES[base](spark, sf_dir).select(*columns)


for _name, (_base, _list) in VIEWS.items():
    QUERIES[_name] = _columns(_base, _list.split())
    ORACLE_SQL[_name] = f"SELECT {', '.join(_list.split())} FROM ({ORACLE_SQL[_base]})"
