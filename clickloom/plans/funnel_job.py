"""Page-flow conversion of one task."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.operators import funnel
from clickloom.params import TaskParams
from clickloom.sinks import TaskRun
from clickloom.sources import actions_by_date


class FunnelAnalysis:
    """Conversion along ``params.page_flow``."""

    def __init__(self, actions: DataFrame, params: TaskParams, task_id: int) -> None:
        if not params.page_flow:
            raise ValueError("the task has no page flow")
        self._actions = actions_by_date(actions, params.start_date, params.end_date)
        self._flow = params.page_flow
        self._task_id = task_id

    def rates(self) -> DataFrame:
        pv = funnel.page_split_pv(self._actions, self._flow)
        start = funnel.start_page_pv(self._actions, self._flow)
        return funnel.page_convert_rate(pv, start, self._flow)

    def rate_string(self) -> DataFrame:
        return funnel.page_convert_rate_string(self.rates(), self._task_id)

    def write_all(self, root: str) -> None:
        """Store the result below ``root``, in place of an earlier run of the task."""
        run = TaskRun(self._actions.sparkSession, root, self._task_id)
        run.write(self.rate_string(), "page_split_convert_rate")
        run.commit()
