"""Session analysis of one task."""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import categories, sampling, sessions
from clickloom.operators.filters import filter_sessions, user_filter
from clickloom.params import TaskParams
from clickloom.sinks import TaskRun
from clickloom.sources import actions_by_date


class SessionAnalysis:
    """Results of one session task. Every result is a lazy DataFrame; nothing is collected.

    The filtered sessions feed all results. Only their numeric columns are worth keeping, and
    :meth:`write_all` caches those. Detail rows are never cached: they are fetched from the action log by
    the few ids asked for.
    """

    def __init__(
        self,
        actions: DataFrame,
        users: DataFrame,
        params: TaskParams,
        task_id: int,
        sample_total: int = 100,
        seed: str = "7",
        top: int = 10,
    ) -> None:
        self._actions = actions_by_date(actions, params.start_date, params.end_date)
        self._users = users
        self._params = params
        self._task_id = task_id
        self._total = sample_total
        self._seed = seed
        self._top = top

    @cached_property
    def sessions(self) -> DataFrame:
        """Sessions with their users that pass the parameters."""
        full = sessions.session_with_user(sessions.session_aggregate(self._actions), self._users)
        return filter_sessions(full, self._params)

    @cached_property
    def _narrow(self) -> DataFrame:
        """The same sessions without their lists, which are expensive and which few results show."""
        matching = sessions.session_matches(self._actions, self._params)
        full = sessions.session_with_user(matching, self._users).where(user_filter(self._params))
        return full.select("session_id", "start_time", "visit_length", "step_length")

    def detail(self) -> DataFrame:
        return sessions.session_detail_columns(self._detail(), self._task_id)

    def _detail(self) -> DataFrame:
        return sessions.session_detail(self._narrow, self._actions)

    def aggr_stat(self) -> DataFrame:
        return sessions.session_aggr_stat(self._narrow, self._task_id)

    def _plan(self) -> DataFrame:
        return sampling.sample_plan(self._narrow, self._total)

    @cached_property
    def _sampled_ids(self) -> DataFrame:
        return sampling.sampled_ids(self._narrow, self._plan(), self._seed, self._total)

    def random_extract(self) -> DataFrame:
        # The lists are built from the actions of the sampled sessions only.
        few = sampling.keep_ids(self._actions, self._sampled_ids, self._total)
        return sampling.random_extract_columns(sessions.session_aggregate(few), self._task_id)

    def sample_detail(self) -> DataFrame:
        rows = sampling.keep_ids(self._actions, self._sampled_ids, self._total)
        return sessions.session_detail_columns(rows, self._task_id)

    @cached_property
    def _top_categories(self) -> DataFrame:
        return categories.top_categories(categories.category_counts(self._detail()), self._top)

    def top_categories(self) -> DataFrame:
        return self._tasked(self._top_categories)

    @cached_property
    def _top_sessions(self) -> DataFrame:
        clicks = categories.top_category_actions(self._top_categories, self._actions, self._top)
        counts = categories.session_category_clicks(clicks)
        return categories.top_sessions(categories.within_sessions(counts, self._narrow), self._top)

    def top_sessions(self) -> DataFrame:
        return self._tasked(self._top_sessions)

    def top_session_detail(self) -> DataFrame:
        rows = categories.top_session_detail(
            self._top_sessions, self._actions, most=self._top * self._top
        )
        return sessions.session_detail_columns(rows, self._task_id)

    def _tasked(self, df: DataFrame) -> DataFrame:
        return df.select(F.lit(self._task_id).cast("bigint").alias("taskid"), "*")

    def write_all(self, root: str) -> None:
        """Store the results below ``root``, all together in place of those of an earlier run of the task."""
        run = TaskRun(self._actions.sparkSession, root, self._task_id)
        cached = [self._narrow, self._sampled_ids, self._top_categories, self._top_sessions]
        for df in cached:
            df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, result in (
                ("session_aggr_stat", self.aggr_stat()),
                ("session_random_extract", self.random_extract()),
                ("top10_category", self.top_categories()),
                ("top10_category_session", self.top_sessions()),
                ("session_detail", self.sample_detail().unionByName(self.top_session_detail())),
            ):
                run.write(result, name)
            run.commit()
        finally:
            for df in cached:
                df.unpersist()
