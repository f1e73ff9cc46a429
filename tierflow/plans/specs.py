"""Layer specifications for turbine readings."""

from __future__ import annotations

from typing import Any


def turbine_specs(
    path: str, database: str, file_format: str = "parquet"
) -> tuple[dict[str, Any], dict[str, Any], dict[str, Any]]:
    """Bronze, silver and gold specification for CSV readings under ``path``."""
    # Table names, bounds, rules and metrics of the turbine tables.
    partitions = ["year", "month"]
    bronze = {
        "source": {
            "path": path,
            "format": "csv",
            "options": {"header": True, "inferSchema": True, "multiLine": True, "escape": '"'},
        },
        "transform": {
            "remove_duplicates": False,
            "add_metadata_columns": ["load_timestamp", "source_file"],
            "column_case": "lowercase",
        },
        "destination": {
            "database": database,
            "table": "bronze_turbines",
            "format": file_format,
            "write_mode": "overwrite",
            "partitions": list(partitions),
        },
    }
    silver = {
        "source": {"database": database, "table": "bronze_turbines"},
        "transform": {
            "deduplication": {"enabled": True},
            "standardization": {"enabled": True, "trim_strings": True, "lowercase": True},
            "quality_checks": {
                "enabled": True,
                "rules": {
                    "turbine_id": {"nulls_allowed": False, "data_type": "string"},
                    "power_output": {
                        "max_nulls_percent": 5, "data_type": "double",
                        "min_value": 0, "max_value": 15000,
                    },
                    "wind_speed": {
                        "max_nulls_percent": 5, "data_type": "double",
                        "min_value": 0, "max_value": 100,
                    },
                    "temperature": {
                        "max_nulls_percent": 10, "data_type": "double",
                        "min_value": -50, "max_value": 60,
                    },
                },
            },
            "business_rules": {
                "enabled": True,
                "rules": [
                    "power_output > 0 when wind_speed > 3",
                    "temperature between -50 and 60",
                ],
            },
            "custom_columns": {
                "power_efficiency": "try_divide(power_output, wind_speed)",
                "month_extracted": "month(load_timestamp)",
                "year_extracted": "year(load_timestamp)",
            },
        },
        "destination": {
            "database": database,
            "table": "silver_turbines",
            "format": file_format,
            "write_mode": "overwrite",
            "partitions": list(partitions),
        },
    }
    gold = {
        "source": {"database": database, "table": "silver_turbines"},
        "transform": {
            "aggregation_grain": "daily",
            "dimensions": ["turbine_id", "agg_date"],
            "metrics": {
                "total_power_output": "sum(power_output)",
                "avg_power_output": "avg(power_output)",
                "max_power_output": "max(power_output)",
                "min_power_output": "min(power_output)",
                "avg_wind_speed": "avg(wind_speed)",
                "avg_temperature": "avg(temperature)",
                "record_count": "count(*)",
            },
            "custom_dimensions": {
                "performance_band": "try_divide(power_output, wind_speed)",
                "turbine_status":
                    "case when power_output > 0 then 'active' else 'inactive' end",
            },
        },
        "destination": {
            "database": database,
            "table": "gold_turbines_metrics",
            "format": file_format,
            "write_mode": "overwrite",
            "partitions": list(partitions),
            "create_view": True,
            "view_name": "gold_turbines_metrics_view",
        },
    }
    return bronze, silver, gold
