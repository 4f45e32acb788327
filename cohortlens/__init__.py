"""cohortlens: one-row-per-person cohort fact tables, built on Spark DataFrames.

Every operator is a plain function from DataFrames (or Columns) to a
DataFrame (or Column).  Nothing runs until an action or a write, so a whole
fact table is one lazy plan that Catalyst optimises and AQE re-plans at run
time.

Layout
------
``sources``    input schemas, readers, the sink, bindings of the test tables
``functions``  Column functions (demographic cleaning, day windows)
``operators``  DataFrame operators (enrich, concepts, flags, visits, stays)
``plans``      compositions (person fact, workflow)
"""

from cohortlens.plans.fact import FactOptions, clean_cohort, index_cohort, person_fact
from cohortlens.plans.workflow import build_outputs
from cohortlens.session import build_session
from cohortlens.sources.io import read_tables
from cohortlens.sources.tables import Tables
from cohortlens.sources.versions import publish, read_published

__all__ = [
    "FactOptions",
    "Tables",
    "build_outputs",
    "build_session",
    "clean_cohort",
    "index_cohort",
    "person_fact",
    "publish",
    "read_published",
    "read_tables",
]
