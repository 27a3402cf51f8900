"""Data contracts applied to Spark DataFrames, in batch and in Structured Streaming.

A contract (driver-side configuration) becomes one lazy plan: load projection, string conversions, rename and cast,
row rules, write projection. For whole estates the contracts themselves become a column-catalog table that
set-based Spark jobs resolve (``contractspark.plans.catalog``).
"""

from .operators.cast import cast_to, rename_cast
from .operators.convert import convert, conversion_expr
from .operators.expect import (Rule, annotate, gate, observe_rules, rule_counts, rules, skipped_rules, summarize,
                               violation_mask)
from .operators.commit import recover, recover_table
from .operators.failures import failure_counts, observe_failures, rejected, with_failures
from .operators.keys import key_violations_against, key_violations_in_two_steps
from .operators.tags import (attach_tags, column_tags, merge_tags, parse_tags, table_tag_map, tag_map,
                             tags_per_entity)
from .operators.write import key_violations, primary_key, save, write_frame, write_schema
from .plans.apply import ContractResult, apply_contract, apply_contracts, run_contracts
from .sources.load import load, read_schema
from .spec import SCD2_COLUMNS, ColumnSpec, ContractError, ContractSpec, ObjectSpec, exclusion_set
from .types import final_type, plan_columns, resolve, conversion_kind

__all__ = [name for name in dir() if not name.startswith("_")]
