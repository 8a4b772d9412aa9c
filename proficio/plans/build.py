"""Models: the dependency order of the models as plain, lazy function calls."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from proficio.params import Params
from proficio.plans import marts, staging, stories
from proficio.sources.catalog import Catalog


class Models:
    """Lazily built models over one catalog and one parameter set.

    Each property is a DataFrame (a plan, not data); reading a model twice
    reuses the same plan object so Spark can reuse its exchanges.
    """

    def __init__(self, catalog: Catalog, params: Params, audit: bool = True):
        self.catalog = catalog
        self.p = params
        self.audit = audit

    # staging
    @cached_property
    def stg_enrollment(self) -> DataFrame:
        return staging.stg_enrollment(self.catalog.table("demographic"), self.p)

    @cached_property
    def stg_attendance(self) -> DataFrame:
        return staging.stg_attendance(self.catalog.table("absenteeism"), self.p)

    @cached_property
    def stg_assessment_scores(self) -> DataFrame:
        return staging.stg_assessment_scores(self.catalog.table("assessment"), self.p)

    # marts
    @cached_property
    def dim_schools(self) -> DataFrame:
        return marts.dim_schools(self.stg_enrollment, self.catalog.table("school_regions"),
                                 self.catalog.table("school_locations"), audit=self.audit)

    def enrollment_trends(self, incremental: bool = False, extra=()) -> DataFrame:
        return marts.enrollment_trends(self.stg_enrollment, self.dim_schools, self.p,
                                       incremental=incremental, audit=self.audit, extra=extra)

    @cached_property
    def school_performance(self) -> DataFrame:
        return marts.school_performance(self.dim_schools, self.stg_enrollment,
                                        self.stg_attendance, self.stg_assessment_scores,
                                        audit=self.audit)

    @cached_property
    def assessment_yoy(self) -> DataFrame:
        return marts.assessment_yoy(self.stg_assessment_scores)

    @cached_property
    def school_improvement_yoy(self) -> DataFrame:
        return marts.school_improvement_yoy(self.assessment_yoy, self.dim_schools)

    @cached_property
    def school_improvement(self) -> DataFrame:
        return marts.school_improvement(self.assessment_yoy, self.dim_schools, self.p)

    # report queries
    def story(self, name: str) -> DataFrame:
        return getattr(stories, name)(self.school_improvement_yoy)
