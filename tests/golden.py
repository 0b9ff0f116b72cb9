"""One tutorial video of 226 s as literals; its texts are made up, of the right lengths."""

SCENES = [
    (0, 0, 32233, 32233), (1, 32233, 78500, 46266), (2, 78500, 88533, 10033), (3, 88533, 90033, 1500), (4, 90033, 90400, 366), (5, 90400, 97466, 7066),
    (6, 97466, 102400, 4933), (7, 102400, 110266, 7866), (8, 110266, 118333, 8066), (9, 118333, 173933, 55600), (10, 173933, 182133, 8199), (11, 182133, 226300, 44166),
]
KEYFRAMES = [
    (0, 0, 0), (1, 0, 5000), (2, 1, 32200), (3, 1, 37233), (4, 2, 78500), (5, 3, 88500), (6, 4, 90000), (7, 5, 90400), (8, 6, 97433), (9, 7, 102400),
    (10, 8, 110233), (11, 9, 118300), (12, 9, 123333), (13, 9, 143333), (14, 9, 173333), (15, 10, 173900), (16, 11, 182100), (17, 11, 187133),
]
CHAPTERS = [(0, 0, 63), (1, 63, 112), (2, 112, 175), (3, 175, 226)]
SEGMENTS = [
    (660, 6460, 91), (7580, 11220, 55), (11200, 14580, 35), (14760, 19980, 114), (20480, 27800, 105), (27780, 30898, 44), (31622, 34840, 52),
    (35600, 40400, 63), (40380, 47760, 81), (48020, 51678, 61), (52140, 56360, 77), (56560, 57022, 5), (57780, 63660, 105), (63640, 66160, 48),
    (66820, 74820, 107), (74980, 77759, 49), (78121, 81000, 53), (81540, 87460, 68), (87780, 89161, 24), (89560, 96200, 108),
    (96620, 101620, 81), (101800, 106200, 82), (106380, 106944, 5), (107529, 111520, 82), (112040, 116380, 59), (116920, 117422, 5),
    (118020, 121260, 54), (121520, 126460, 82), (126560, 131420, 44), (131780, 138320, 104), (138300, 141160, 70), (142460, 145240, 58),
    (145460, 147300, 23), (147400, 157120, 140), (157300, 161160, 61), (161300, 161663, 5), (161700, 171400, 171), (171540, 171923, 5),
    (171980, 172881, 18), (173280, 175680, 28), (175800, 176084, 4), (176060, 180360, 58), (181140, 184500, 64), (184760, 197320, 144),
    (197880, 204620, 99), (204720, 205681, 13), (205780, 206044, 3), (206060, 207181, 23), (207280, 217660, 139), (217760, 218103, 5),
    (218120, 219920, 25), (220200, 221421, 26), (221560, 223380, 46),
]


def write(root: str, video: str = "golden") -> None:
    """The artefacts as files, in the exchange format."""
    import json
    import os

    os.makedirs(f"{root}/{video}/source")
    put = lambda name, doc: json.dump(doc, open(f"{root}/{video}/{name}.json", "w"))
    put("source/metadata", {"id": video, "title": "Golden", "duration": 226, "channel": "c", "upload_date": "20240101", "tags": ["a"], "description": "d" * 600, "chapters": [{"title": f"T{i}", "start_time": a, "end_time": b} for i, a, b in CHAPTERS]})
    put("scenes", {"total_scenes": 12, "scenes": [{"scene_id": i, "start_ms": a, "end_ms": b, "start_frame": 0, "end_frame": 0, "duration_ms": d} for i, a, b, d in SCENES]})
    put("keyframes", {"keyframes": [{"frame_id": f, "scene_id": s, "timestamp_ms": t, "frame_number": 0, "filename": f"frame_{f:05d}.jpg", "path": f"x/frame_{f:05d}.jpg", "blur_score": 200.0, "width": 1, "height": 1} for f, s, t in KEYFRAMES]})
    put("asr", {"segments": [{"start": a, "end": b, "text": "w" * n, "words": [{"word": "w", "start": a, "end": b, "score": 0.5}]} for a, b, n in SEGMENTS]})
    put("ocr", {"results": [{"frame_id": f, "scene_id": s, "timestamp_ms": t, "image_path": f"y/frame_{f:05d}.jpg", "text_blocks": [{"text": f"label {f}", "bbox": [0, 0, 5, 5], "confidence": 0.9}], "full_text": f"label {f}", "total_blocks": 1} for f, s, t in KEYFRAMES]})
