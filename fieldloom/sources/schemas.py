"""Declared entity schemas: one StructType each, required fields, and defaults."""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S, B, TS, V = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampType(), T.VariantType()
TAGS = T.ArrayType(S)


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


VEC3 = _struct(x=D, y=D, z=D)
QUAT = _struct(x=D, y=D, z=D, w=D)
FRAME_IMAGE = _struct(image_url=S, position=VEC3, heading=QUAT, width=L, height=L, fx=D, fy=D, cx=D, cy=D, model=S, camera_model=S, camera=S, camera_id=S, sensor_id=S, xi=D, alpha=D)
FRAME = _struct(frame_index=L, key=S, model=S, camera_model=S, xi=D, alpha=D, device_position=VEC3, device_heading=QUAT, images=T.ArrayType(FRAME_IMAGE), image_urls=TAGS, raw=V)

ENTITIES = {
    "dataset": _struct(uid=S, name=S, slug=S, item_count=L, status=S, data_type=S, is_sequence=B, predefined_labels=V, created_at=TS, updated_at=TS),
    "item": _struct(id=L, uid=S, key=S, dataset=S, dataset_owner_name=S, dataset_slug=S, url=S, gpu_texture_url=S, thumbnails=V, video_thumbnail=S, metadata=V, export_snippet=V, annotations=V, crop_data=V, related_items=V, related_sequence_uid=S, created_at=TS, updated_at=TS),
    "sequence": _struct(uid=S, key=S, custom_uuid=S, status=S, featured_image=S, number_of_frames=L, views=V, crop_data=V, predefined_labels=V, frames=T.ArrayType(V), metrics=V, dataset_uid=S, allow_lidar_calibration=B, lidar_calibration_enabled=B, camera_calibration_enabled=B, coc_timeline=V),
    "slice": _struct(uid=S, name=S, slug=S, owner_name=S, organization=S, visibility=S, status=S, item_count=L, sub_slices=T.ArrayType(V), source_data=V, featured_slice_item_urls=TAGS),
    "project": _struct(uid=S, name=S, status=S, created_at=TS, updated_at=TS),
    "task": _struct(uid=S, type=S, name=S, status=S, project=S, created_at=TS, updated_at=TS),
    "export": _struct(uid=S, status=S, download_url=S, created_at=TS, updated_at=TS),
    "consensus_config": _struct(iou_threshold=D, min_agreement_ratio=D, min_annotations=L),
    "consensus_score": _struct(uid=S, dataset_item_uid=S, task_name=S, score_type=S, score=D, annotator_count=L, details=V, created_at=TS),
    "quality_target": _struct(uid=S, name=S, metric=S, operator=S, threshold=D, severity=S, is_active=B, notify_webhook=B, notify_emails=TAGS, is_breached=B, breach_count=L, last_value=D, last_evaluated_at=TS, last_breached_at=TS, created_at=TS, updated_at=TS),
    "annotation_issue": _struct(uid=S, dataset_item_uid=S, sequence_uid=S, project=V, reporter=V, priority=S, severity=S, description=S, status=S, tool=V, problem=V, wrong_class=S, correct_class=S, should_re_annotate=B, should_delete=B, frames_affected=S, coordinates=V, query_params=V, created_at=TS, closed_at=TS, object_uid=S),
    "issue_tool": _struct(uid=S, name=S, dataset_type=S, default=B, problems=T.ArrayType(_struct(uid=S, title=S))),
    "auto_label_job": _struct(uid=S, status=S, model_type=S, confidence_threshold=D, labels=TAGS, dry_run=B, total_items=L, processed_items=L, successful_items=L, failed_items=L, skipped_items=L, progress_pct=D),
    "agent": _struct(uid=S, name=S, events=TAGS, task_types=TAGS, execution_stats=T.MapType(S, L)),
    "agent_execution": _struct(uid=S, registration=S, event_type=S, status=S, action=S),
    "device": _struct(uid=S, name=S, type=S, status=S, tags=TAGS, firmware_version=S, metadata=V, last_seen_at=TS, created_at=TS, updated_at=TS),
    "recording": _struct(uid=S, device=S, status=S, duration_seconds=D, size_bytes=L, started_at=TS, ended_at=TS, topic_count=L, topics=T.ArrayType(V), tags=TAGS),
    "event": _struct(recording=S, device=S, label=S, type=S, timestamp=TS, severity=S, description=S, duration_ms=L, tags=TAGS, metadata=V),
    "rule": _struct(uid=S, name=S, condition=_struct(field=S, op=S, value=D), actions=T.ArrayType(_struct(type=S)), scope=_struct(device_type=S), enabled=B, hit_count=L, last_hit_at=TS),
    "alert": _struct(uid=S, rule=S, device=S, recording=S, severity=S, status=S, message=S, triggered_at=TS, acknowledged_at=TS, acknowledged_by=S, resolved_at=TS, resolution_note=S),
    "channel": _struct(uid=S, name=S, type=S, config=V),
    "webhook_delivery": _struct(uid=S, subscription=S, event_type=S, payload=V, response_status=L, attempts=L, next_retry_at=TS, status=S),
    "organization": _struct(uid=S, name=S, slug=S, member_count=L, team_count=L, dataset_count=L, project_count=L, slice_count=L),
    "member": _struct(uid=S, username=S, email=S, full_name=S, role=S, organization=S),
    "team": _struct(uid=S, name=S, organization=S, member_count=L),
    "invitation": _struct(uid=S, email=S, role=S, status=S, organization=S),
    "storage_config": _struct(uid=S, name=S, provider=S, organization=S, is_verified=B),
    "inference_provider": _struct(uid=S, name=S, provider_type=S, is_active=B),
    "upload_session": _struct(uid=S, recording=S, status=S, confirmed_files=L, total_files=L, pending_paths=TAGS),
    "upload_url": _struct(path=S, put_url=S, s3_key=S, headers=T.MapType(S, S)),
}

REQUIRED = {
    "dataset": ["uid", "name", "slug"], "slice": ["uid", "name"], "project": ["uid", "name"], "agent": ["uid", "name"], "agent_execution": ["uid", "registration", "event_type"],
    "event": ["recording", "device", "label", "type", "timestamp"], "webhook_delivery": ["uid", "subscription", "event_type"], "consensus_config": [],
}

#: Defaults of optional fields.
DEFAULTS = {
    "dataset": {"item_count": 0},
    "consensus_config": {"iou_threshold": 0.5, "min_agreement_ratio": 0.5, "min_annotations": 2},
    "webhook_delivery": {"attempts": 0},
}


def required(entity: str) -> list[str]:
    return REQUIRED.get(entity, ["uid"])
