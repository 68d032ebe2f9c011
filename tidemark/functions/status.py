"""Status mapping, routing and the minute gate as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import GATE_MINUTES

# Run states and actions other systems see.
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"
POLL = "POLL"
COMPLETED = "COMPLETED"
ERROR = "ERROR"

# Names of the steps a row is routed to.
SUCCEED_STEP = "succeed"
FAIL_STEP = "fail"
WAIT_STEP = "wait"
POLL_STEP = "poll"


def action_status(run_state: Column) -> Column:
    """Terminal run states pass through; anything else, or no run, means poll."""
    return F.when(run_state.isin(SUCCEEDED, FAILED), run_state).otherwise(POLL)


def in_gate(at: Column, minutes: int = GATE_MINUTES) -> Column:
    """True during the first minutes of an hour."""
    return F.minute(at) < minutes


def gate_step(check: Column) -> Column:
    """Step after the export: look at the job only while the gate is open."""
    return F.when(check, POLL_STEP).when(~check, SUCCEED_STEP)


def action_step(action: Column) -> Column:
    """Step after a poll."""
    return (
        F.when(action == SUCCEEDED, WAIT_STEP)
        .when(action == FAILED, FAIL_STEP)
        .when(action == POLL, POLL_STEP)
    )


def route(check: Column, action: Column) -> Column:
    """Next step from the gate and, when it is open, the polled action."""
    return F.when(check, action_step(action)).otherwise(gate_step(check))
