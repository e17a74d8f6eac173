"""Parameters of the registered queries (one forecast scenario over the fixtures).

Fixed values: the scenario forecasts the last campaign of the fixture calendar
(campaign 69, starting Tuesday 2001-07-10) four weeks ahead.
"""

CAMPAIGN_START = "2001-07-10"
CAMPAIGN_END = "2001-07-30"
FORECAST_DATE = "2001-06-12"
WEEKDAY = 1            # Tuesday: weeks align to the campaign start weekday
HORIZON = 4            # weeks between forecast date and campaign start
DELIVERY_FLOOR = "1996-01-01"
BACKTEST_YEAR = 2000
