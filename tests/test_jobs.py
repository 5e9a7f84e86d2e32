"""Report jobs over a stored warehouse: compute, write (append by default),
read back."""

from collections import Counter

from auditmart.jobs import Warehouse, run_all
from auditmart.plans import daily_cancel, program_audit, signup_time, waitlist
from auditmart.queries import audit, programs, slots, states
from auditmart.sources import read_table, scratch_path, write_table
from conftest import SF


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_run_all_writes_every_report(spark):
    """The program table lists every program twice, so withdrawals and
    cancellations count twice."""

    def twice(spark, sf):
        return programs(spark, sf).union(programs(spark, sf))

    root = scratch_path(spark, "test/warehouse")
    for name, df in (("audit", audit), ("slots", slots), ("programs", twice), ("states", states)):
        write_table(df(spark, SF["0.01"]), f"{root}/{name}", mode="overwrite")
    wh = Warehouse(
        audit=f"{root}/audit",
        slots=f"{root}/slots",
        programs=f"{root}/programs",
        application_states=f"{root}/states",
        program_audit_report=f"{root}/rpt_program_audit",
        waitlist_report=f"{root}/rpt_waitlist",
        signup_time_report=f"{root}/rpt_signup_time",
        daily_cancel_report=f"{root}/rpt_daily_cancel",
    )
    run_all(spark, wh)
    a, s, st = audit(spark, SF["0.01"]), slots(spark, SF["0.01"]), states(spark, SF["0.01"])
    assert bag(read_table(spark, wh.program_audit_report)) == bag(program_audit.report(a, s, twice(spark, SF["0.01"])))
    assert bag(program_audit.report(a, s)) != bag(program_audit.report(a, s, twice(spark, SF["0.01"])))
    assert bag(read_table(spark, wh.waitlist_report)) == bag(waitlist.report(a, st))
    assert bag(read_table(spark, wh.signup_time_report)) == bag(signup_time.report(a))
    assert bag(read_table(spark, wh.daily_cancel_report)) == bag(daily_cancel.report(a))
    run_all(spark, wh)  # default append: a rerun duplicates rows, as in the source
    assert read_table(spark, wh.daily_cancel_report).count() == 2 * daily_cancel.report(a).count()
    run_all(spark, wh, mode="overwrite")
    assert read_table(spark, wh.daily_cancel_report).count() == daily_cancel.report(a).count()
