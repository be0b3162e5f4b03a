from ferry.sinks.files import Target, write, written_bytes
from ferry.sinks.landing import landed, read_landed
from ferry.sinks.paths import extension, hadoop_path, output_path, render_name

__all__ = ["Target", "extension", "hadoop_path", "landed", "output_path", "read_landed", "render_name", "write", "written_bytes"]
