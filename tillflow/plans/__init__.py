"""End-to-end jobs: the weekly batch and the session stream."""

from tillflow.plans.weekly_job import run_weekly_job, weekly_result  # noqa: F401
from tillflow.plans.session_job import start_session_job  # noqa: F401
