"""Hand-made golden fixtures A and B (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt

from auditmart import model as m


def ts(s: str | None):
    return None if s is None else dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def day(s: str | None):
    return None if s is None else dt.date.fromisoformat(s)


# (program, season, created_by, user, op, event, application, created_date)
AUDIT_A = [
    (1, 1, 90, 10, 1, None, None, "2017-09-01 08:00:00"),
    (1, 1, 90, 11, 1, None, None, "2017-09-01 23:59:59"),
    (1, 1, 90, 12, 1, None, None, "2017-09-03 09:00:00"),
    (1, 1, 10, 10, 2, 500, None, "2017-09-02 08:00:00"),
    (1, 1, 10, 10, 3, 500, 7010, "2017-09-02 09:00:00"),
    (1, 1, 11, 11, 3, 500, 7011, "2017-09-02 10:00:00"),
    (1, 1, 11, 11, 3, 500, 7011, "2017-09-02 10:00:00"),
    (1, 1, 11, 11, 2, 500, None, "2017-09-04 10:00:00"),
    (1, 1, 12, 12, 3, 501, 7012, "2017-09-04 00:00:00"),
    (1, 1, 12, 12, 4, None, 7012, "2017-09-05 00:00:00"),
    (1, 1, 13, 13, 2, 502, None, "2017-09-06 00:00:00"),
    (1, 1, 13, 13, 5, 502, None, "2017-09-06 01:00:00"),
    (1, 1, None, 13, 5, 502, None, "2017-09-06 02:00:00"),
    (2, 1, 91, 10, 1, None, None, "2017-09-02 07:59:59"),
    (2, 1, 20, 20, 3, None, 7020, "2017-09-03 00:00:00"),
    (4, 1, 92, 30, 1, None, None, "2017-10-01 00:00:00"),
]
SLOTS_A = [(1, 1, 2), (1, 1, 1), (2, 1, 0), (3, 1, 5)]
STATES_A = [(7010, 4), (7011, 1), (7012, 2), (7020, 4)]

AUDIT_B = [
    (5, 1, 90, 40, 1, None, None, "2017-10-01 08:00:00"),
    (5, 1, 90, 40, 1, None, None, "2017-10-01 09:00:00"),
    (5, 1, 40, 40, 2, 600, None, "2017-10-02 08:00:00"),
    (5, 1, 40, 40, 3, 600, None, "2017-10-03 08:00:00"),
    (5, 1, 40, 40, 3, 600, None, "2017-10-04 08:00:00"),
    (5, 1, 90, 41, 1, None, None, "2017-10-01 08:00:00"),
    (5, 1, 41, 41, 2, 601, None, "2017-10-02 08:00:30"),
    (6, 1, 41, 41, 3, 601, None, "2017-10-03 00:00:00"),
    (5, 1, 90, 42, 1, None, None, "2017-10-02 00:00:00"),
    (5, 1, 42, 42, 2, 602, None, "2017-10-02 00:00:10"),
    (5, 1, 42, 42, 3, 602, None, None),
    (7, None, 91, 43, 1, None, None, "2017-10-01 00:00:00"),
    (7, None, 43, 43, 3, None, 8043, "2017-10-02 00:00:00"),
    (8, 1, 92, 44, 1, None, None, "2017-10-01 00:00:00"),
    (8, 1, 44, 44, 2, 603, None, "2017-10-05 00:00:00"),
    (8, 1, 44, 44, 3, 604, 8044, "2017-10-05 00:00:00"),
    (8, 1, 45, 45, 3, 605, 8045, "2017-10-06 00:00:00"),
    (8, 1, 45, 45, 3, 606, 8046, "2017-10-06 00:00:00"),
]
SLOTS_B = [(5, 1, 32), (7, None, 4)]
STATES_B = [(8043, 1), (8044, 1), (8045, 3), (8046, 5)]


def audit_df(spark, rows):
    data = [
        (p, by, s, op, ev, ts(t), u, app)
        for (p, s, by, u, op, ev, app, t) in rows
    ]
    return spark.createDataFrame(data, m.AUDIT_SCHEMA)


def slots_df(spark, rows):
    return spark.createDataFrame(rows, m.SLOT_SCHEMA)


def states_df(spark, rows):
    return spark.createDataFrame(rows, m.APPLICATION_STATE_SCHEMA)


# --- expected results ---------------------------------------------------------
# program audit, columns in report order
PROGRAM_AUDIT_A = [
    (1, 1, 3, 3, 1, 2, 2, 1, -1, 1.0, day("2017-09-01"), -1, 0.67, -2, 2.33, 66.7, 33.3, 0.0),
    (2, 1, 0, 1, 0, 0, 1, 0, 1, None, day("2017-09-02"), 1, None, 0, None, 100.0, 0.0, 100.0),
    (3, 1, 5, 0, 0, 0, 0, 0, -5, 0.0, None, -5, 0.0, -5, 0.0, None, None, None),
]
PROGRAM_AUDIT_B = [
    (5, 1, 32, 4, 0, 0, 3, 1, -28, 0.13, day("2017-10-01"), -29, 0.09, -31, 3.91, 75.0, 25.0, 100.0),
    (7, None, 4, 0, 0, 0, 0, 0, -4, 0.0, None, -4, 0.0, -4, 0.0, None, None, None),
]
WAITLIST_A = [
    (1, 1, 3, 2, 1, 1, 2, 0, 66.7, 50.0, 50.0, 100.0, 0.0),
    (2, 1, 1, 1, 0, 0, 0, 1, 100.0, 0.0, 0.0, 0.0, 100.0),
    (4, 1, 1, 0, 0, 0, 0, 0, 0.0, None, None, None, None),
]
WAITLIST_B = [
    (5, 1, 4, 0, 0, 0, 0, 0, 0.0, None, None, None, None),
    (7, None, 1, 0, 0, 0, 0, 0, 0.0, None, None, None, None),
    (8, 1, 1, 3, 1, 1, 2, 0, 300.0, 33.3, 33.3, 66.7, 0.0),
]
SIGNUP_A = [(1, 1, 10, 86400)]
SIGNUP_B = [
    (5, 1, 40, 86400),
    (5, 1, 40, 86400),
    (5, 1, 40, 82800),
    (5, 1, 40, 82800),
    (5, 1, 41, 86430),
    (5, 1, 42, 10),
]
DAILY_CANCEL_A = [(1, 1, day("2017-09-06"), 1)]
DAILY_CANCEL_B: list = []
