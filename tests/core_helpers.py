import os


def write_text(path, lines, newline="\n", end=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(newline.join(lines) + (newline if end else ""))
    return path
