"""Schemas of the artefacts of a video."""

from __future__ import annotations

CHAPTER = "title string, start_time double, end_time double"
METADATA = (
    "id string, title string, description string, duration bigint, upload_date string, uploader string, uploader_id string, channel string, "
    "channel_id string, view_count bigint, like_count bigint, tags array<string>, categories array<string>, license string, width int, height int, "
    f"fps double, resolution string, chapters array<struct<{CHAPTER.replace(' ', ':').replace(',:', ',')}>>, "
    "subtitles_available array<string>, automatic_captions_available array<string>"
)
WORD = "struct<word:string,start:bigint,`end`:bigint,score:double,probability:double>"
SEGMENT = f"struct<start:bigint,`end`:bigint,text:string,speaker:string,confidence:double,words:array<{WORD}>>"
ASR = f"audio_path string, model string, language string, aligned boolean, diarized boolean, segments array<{SEGMENT}>"
SCENE = "struct<scene_id:int,start_ms:bigint,end_ms:bigint,start_frame:bigint,end_frame:bigint,duration_ms:bigint>"
SCENES = f"video_path string, total_scenes int, detection_threshold double, min_scene_len double, scenes array<{SCENE}>"
KEYFRAME = "struct<frame_id:int,scene_id:int,timestamp_ms:bigint,frame_number:bigint,filename:string,path:string,blur_score:double,width:int,height:int>"
KEYFRAMES = f"video_path string, total_keyframes int, blur_threshold double, keyframes array<{KEYFRAME}>"
BLOCK = "struct<text:string,bbox:array<double>,bbox_polygon:array<array<double>>,confidence:double>"
REGION = "struct<type:string,bbox:array<double>,confidence:double>"
FRAME = (
    f"struct<frame_id:int,timestamp_ms:bigint,scene_id:int,image_path:string,width:int,height:int,text_blocks:array<{BLOCK}>,"
    f"layout_regions:array<{REGION}>,full_text:string,total_blocks:int,total_regions:int>"
)
OCR = f"total_keyframes int, ocr_lang string, conf_threshold double, layout_model string, results array<{FRAME}>"
CHUNK = (
    "chunk_id string, video_id string, source string, t_start_ms bigint, t_end_ms bigint, chapter_index int, chapter_title string, scene_id int, "
    "asr_text string, ocr_text string, merged_text string, keyframe_ids array<int>, keyframe_paths array<string>, has_keyframe boolean, "
    "asr_confidence double, ocr_confidence double, alignment_score double, "
    "completeness struct<has_speech:boolean,has_visual:boolean,has_ocr_text:boolean>, "
    "provenance struct<video_title:string,channel:string,publish_date:string,tags:array<string>,video_description:string>, "
    "text_embedding array<float>, image_embedding array<float>"
)
QA_PAIRS = "array<struct<question:string,answer:string,evidence_type:string>>"
PROBE = (
    "format struct<duration:string,format_name:string,bit_rate:string>, streams array<struct<codec_type:string,codec_name:string,width:int,"
    "height:int,r_frame_rate:string,bit_rate:string,sample_rate:string,channels:int>>"
)
