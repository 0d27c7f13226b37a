"""Parameters of the workshop queries at fixture scale.

The reference's minute/hour windows are scaled up because the fixture's
events are spread over 30 days (10,000 rows at sf0.01): at one minute almost
every window would hold a single row.  The reference values are kept next to
each one.
"""

from decimal import Decimal

GROUP_SUM_THRESHOLD = 500            # reference 500
RUNNING_RANGE = "3 days"             # reference 1 hour (W1) / 1 minute (W2)
RUNNING_THRESHOLD = 100              # reference 500
FLAGGED_RANGE = "3 days"             # reference 2 hours
FLAGGED_THRESHOLD = 300              # reference 1000
DUAL_RANGE = "3 days"                # reference 1 hour
DUAL_WITHDRAW_THRESHOLD = 100        # reference 500
DUAL_FX_THRESHOLD = 100              # reference 300
TUMBLE_SIZE = "1 day"                # reference 1 minute
TUMBLE_LAG_SIZE = "1 day"            # reference 1 minute
SESSION_GAP = "1 hour"               # reference 5 seconds (merchants see an event every ~1.4 h)
INTERVAL_WIDTH = "3 days"            # reference 10 seconds
INTERVAL_LEFT_WIDTH = "12 hours"     # left-outer variant: narrower, so many transactions find no version
TTL_BOTH = "2 days"                  # reference '2d'
TTL_LEFT = "12 hours"                # reference 't' = 10 s
TTL_RIGHT = "3 days"                 # reference 'c' = 1 h
HIGH_SPENDER_THRESHOLD = 3500        # reference 1000; account totals at sf0.01: median 3,283
PATTERN_WINDOW = "3 days"            # reference 1 minute (M1, M2) / 2 minutes (M3)
RECURRING_FAILED_RANGE = "3 days"    # frame for the 'recurring failed' risk rule
RECURRING_FAILED_MIN = 2
LOG_RANGE_LOW = 20.0                 # log_out_of_range bounds on amounts
LOG_RANGE_HIGH = 400.0
RANDOM_STRING_MAX = 12
LARGE_AMOUNT = 300                   # side of the full outer join that some accounts lack
SPEND_BAND = 5000                    # sink key of C6: cities of one band share it (reference: the spend itself)
START_TIME = "2024-01-10 00:00:00"   # scan.startup: rows from this time on
#: INSERT INTO .. VALUES: account, transaction, amount.
INSERTED = [("ACC0000001", "v1", Decimal("12.50")), ("ACC0000001", "v2", Decimal("0.25")), ("ACC1000001", "v3", None)]
