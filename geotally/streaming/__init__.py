from .incremental import (read_message_stream, read_running_counts, read_running_model, start_model_updates,
                          start_running_counts)

__all__ = ["read_message_stream", "read_running_counts", "read_running_model", "start_model_updates",
           "start_running_counts"]
