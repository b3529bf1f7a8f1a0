import json
import os
import uuid

from perennia.sources.json_events import read_events


LAYOUTS = ("one line", "line per element", "indented")


def array_text(events, layout="line per element"):
    """A JSON array as one line, with each element on a line of its own, or with each field on one."""
    if layout == "line per element":
        return "[" + ",\n".join(map(json.dumps, events)) + "]\n"
    return json.dumps(events, indent=2 if layout == "indented" else None)


def write_array(folder, events, name=None, layout="line per element"):
    path = os.path.join(folder, name or f"{uuid.uuid4().hex}.txt")
    with open(path, "w") as f:
        f.write(events if isinstance(events, str) else array_text(events, layout))
    return path


def log_of(spark, folder, *arrays):
    """Event arrays, one file each, read back as a log."""
    for i, events in enumerate(arrays):
        write_array(folder, events, f"part{i}.txt")
    return read_events(spark, folder)
