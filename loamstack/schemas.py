"""Explicit schemas of the corpus tables; nothing is inferred when a schema is known."""

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in (x.split(":") for x in spec.split())])


def schema(table: str) -> T.StructType:
    """The schema of a corpus table (a Spark session must be running)."""
    return _struct(_SPECS[table])


_SPECS = {
    "processed_files": "id:int job_id:int file_path:string relative_path:string content:string language:string lines:int "
    "size:long hash:string repo_name:string processed_at:timestamp_ntz quality_score:int",
    "repositories": "id:int full_name:string name:string description:string url:string language:string stars:int forks:int "
    "quality_score:int local_path:string download_status:string downloaded_at:timestamp_ntz code_lines:int file_count:int "
    "created_at:timestamp_ntz updated_at:timestamp_ntz",
    "processing_jobs": "id:int repo_path:string status:string files_found:int files_processed:int started_at:timestamp_ntz "
    "completed_at:timestamp_ntz error_msg:string worker_id:string created_at:timestamp_ntz updated_at:timestamp_ntz",
    "processing_checkpoints": "id:int worker_id:string last_job_id:int last_processed_count:long checkpoint_time:timestamp_ntz",
    "training_state": "id:int model_name:string last_trained_id:long total_training_runs:int total_samples_trained:long "
    "last_training_time:timestamp_ntz best_eval_loss:double best_model_path:string created_at:timestamp_ntz updated_at:timestamp_ntz",
    "metric_samples": "ts:timestamp_ntz kind:string name:string labels:map<string,string> value:double",
}

UNIQUE_KEYS = {
    "processed_files": ["id", "hash"],
    "repositories": ["id", "full_name"],
    "processing_jobs": ["id", "repo_path"],
    "processing_checkpoints": ["id"],
    "training_state": ["id", "model_name"],
}
