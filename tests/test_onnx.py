"""The ONNX plug-in with a hand-encoded graph (the onnx builder package is not installed)."""

import struct

import numpy as np
import pytest

ort = pytest.importorskip("onnxruntime")


def _varint(n):
    out = b""
    while True:
        b = n & 0x7F
        n >>= 7
        out += bytes([b | (0x80 if n else 0)])
        if not n:
            return out


def _field(num, wire, payload):
    key = _varint((num << 3) | wire)
    if wire == 0:
        return key + _varint(payload)
    return key + _varint(len(payload)) + payload


def _s(num, text):
    return _field(num, 2, text.encode())


def _tensor(name, arr):
    # TensorProto: dims=1, data_type=2 (FLOAT=1), raw_data=9, name=8
    body = b"".join(_field(1, 0, d) for d in arr.shape) + _field(2, 0, 1) + _s(8, name) \
        + _field(9, 2, arr.astype("<f4").tobytes())
    return body


def _value_info(name, dims):
    # ValueInfoProto{name=1, type=2{tensor_type=1{elem_type=1, shape=2{dim=1{dim_value=1 | dim_param=2}}}}}
    shape = b"".join(_field(1, 2, _field(1, 0, d) if isinstance(d, int) else _s(2, d)) for d in dims)
    tensor_type = _field(1, 0, 1) + _field(2, 2, shape)
    return _s(1, name) + _field(2, 2, _field(1, 2, tensor_type))


def _matmul_relu_model(w):
    node1 = _s(1, "x") + _s(1, "w") + _s(2, "h") + _s(4, "MatMul")
    node2 = _s(1, "h") + _s(2, "y") + _s(4, "Relu")
    graph = (_field(1, 2, node1) + _field(1, 2, node2) + _s(2, "g") + _field(5, 2, _tensor("w", w))
             + _field(11, 2, _value_info("x", ["n", w.shape[0]])) + _field(12, 2, _value_info("y", ["n", w.shape[1]])))
    opset = _s(1, "") + _field(2, 0, 13)
    return _field(1, 0, 7) + _field(7, 2, graph) + _field(8, 2, opset)


def test_onnx_scorer_matches_numpy(spark, emb, tmp_path):
    from headstart.operators.onnx_scorer import onnx_scorer
    from headstart.operators.scoring import featurize

    w = ((np.arange(64)[:, None] * 31 + np.arange(5)[None, :] * 17) % 13 - 6) / 20.0
    path = tmp_path / "head.onnx"
    path.write_bytes(_matmul_relu_model(w))
    ort.InferenceSession(str(path))  # the hand-encoded graph loads
    out = featurize(emb, onnx_scorer(spark, str(path)), input_col="embedding", output_col="f",
                    keep=["vec_id"]).join(emb, "vec_id").select("f", "embedding").collect()
    for r in out[:50]:
        want = np.maximum(np.asarray(r.embedding, dtype=np.float32) @ w.astype(np.float32), 0)
        assert np.allclose(r.f, want, atol=1e-5)


def test_channels_first_transposes_not_reshapes(spark, tmp_path):
    from headstart.operators.onnx_scorer import onnx_scorer

    # identity-like graph: MatMul with an identity matrix over 2*3*3 = 18 inputs
    path = tmp_path / "id.onnx"
    path.write_bytes(_matmul_relu_model(np.eye(18)))
    x = np.arange(18, dtype=np.float64)[None, :]  # one image, h=2, w=3, c=3, values >= 0
    plain = onnx_scorer(spark, str(path))()(x)
    assert np.array_equal(plain, x)
    fn = onnx_scorer(spark, str(path), input_shape=(2, 3, 3), channels_first=True)
    with pytest.raises(Exception):  # the graph takes a flat (n, 18) input, not NCHW
        fn()(x)
    # the transpose itself: NHWC → NCHW
    img = x.reshape(1, 2, 3, 3)
    assert np.array_equal(img.transpose(0, 3, 1, 2)[0, 0], img[0, :, :, 0])
