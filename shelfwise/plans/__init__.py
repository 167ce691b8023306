"""Result records, and the queries that check the steps behind them."""
