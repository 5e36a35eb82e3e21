"""Declared schemas of the tables that the operators read and write."""

from __future__ import annotations

MESSAGE = "struct<role:string,content:string>"
MESSAGES = f"array<{MESSAGE}>"
USAGE = "struct<input_tokens:bigint,output_tokens:bigint>"

SOURCE_FILE = "path string, modificationTime timestamp, length bigint, content binary"
EXAMPLE = (
    f"messages {MESSAGES}, metadata struct<function_name:string,context:string,source:string,type:string,domain:string>"
)
SPLIT_LINE = f"messages {MESSAGES}"
PROMPT = "id string, prompt string"
TEACHER_BODY = f"struct<content:array<struct<text:string>>,usage:{USAGE}>"
TEACHER_RESULT = (
    f"id string, prompt string, response string, success boolean, error string, usage {USAGE}, timestamp string"
)
SCORE = "struct<syntax:double,protocol:double,safety:double,style:double,overall:double>"
EPOCH_METRICS = (
    "epoch int, train_loss double, avg_student_score double, num_eval_samples int, num_poor_outputs int, "
    "num_corrections int, correction_rate double, "
    "scores_distribution struct<below_5:bigint,`5_to_7`:bigint,`7_to_9`:bigint,above_9:bigint>, timestamp string"
)
CORRECTION = (
    "id string, original_prompt string, student_output string, student_score double, teacher_correction string, "
    f"epoch int, messages {MESSAGES}, usage {USAGE}"
)
TRAINING_LOG = "step bigint, loss double, eval_loss double"
CONTEXT = (
    "id string, summary string, full_text string, timestamp timestamp, session_id string, token_count int, "
    "embedding array<float>"
)
TOPIC = "id string, name string, description string, embedding array<float>"
CODE_ENTITY = "id string, file_path string, entity_type string, name string, embedding array<float>"
SESSION = "id string, project string, start_time timestamp"
EDGE = "src string, dst string"
