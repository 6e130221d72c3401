"""User-defined SQL functions and reusable session tags."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def register_sql_function(spark: SparkSession, name: str, args: dict[str, str], returns: str, body: str) -> None:
    """Create a temporary SQL function; Catalyst inlines it, so there is no Python in the plan."""
    params = ", ".join(f"{arg} {type_name}" for arg, type_name in args.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")


def query_tag(client: str, env: str, model: str, run_id: str) -> str:
    """Tag text used for cost attribution."""
    return json.dumps({"client": client, "env": env, "model": model, "run_id": run_id})


def set_query_tag(spark: SparkSession, client: str, env: str, model: str, run_id: str) -> None:
    """Label the jobs started next with the tag (shown in the UI and the event log)."""
    spark.sparkContext.setJobDescription(query_tag(client, env, model, run_id))


def schema_for(custom_schema: str | None, default_schema: str) -> str:
    """Schema a model is routed to: its own when given, else the target's; upper case."""
    return (custom_schema or default_schema).upper()
