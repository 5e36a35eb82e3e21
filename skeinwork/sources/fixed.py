"""The sources of code, their domains and contexts; and built-in prompts."""

from __future__ import annotations

#: Fixed values: (prefix, domain, contexts).
SOURCES: list[tuple[str, str, list[str]]] = [
    ("tsn_data/", "tsn", [
        "Time-Sensitive Networking (TSN)",
        "IEEE 802.1Qbv Time-Aware Shaper",
        "IEEE 802.1Qav Credit-Based Shaper",
        "IEEE 802.1AS Precision Time Protocol",
        "TSN stream scheduling",
    ]),
    ("avb_data/", "avb", [
        "Audio Video Bridging (AVB)",
        "AVB Stream Reservation Protocol",
        "AVB audio streaming",
        "AVTP timestamp processing",
        "gPTP synchronization",
    ]),
    ("advanced_academic/carla_autonomous_driving_simulator/", "carla", [
        "CARLA autonomous driving simulator",
        "vehicle control system",
        "sensor data processing",
        "autonomous vehicle perception",
        "vehicle physics simulation",
    ]),
    ("advanced_embedded/", "embedded", [
        "embedded automotive systems",
        "bare-metal firmware",
        "hardware abstraction layer",
        "peripheral driver development",
        "embedded C real-time systems",
    ]),
    ("phase_2_embedded/", "embedded_p2", [
        "embedded automotive firmware",
        "MCU peripheral drivers",
        "low-level hardware interface",
        "embedded systems programming",
    ]),
    ("phase_3_embedded/", "embedded_p3", [
        "production embedded firmware",
        "automotive ECU software",
        "embedded C safety-critical code",
        "vehicle embedded controller",
    ]),
    ("advanced_rtos/", "rtos", [
        "real-time operating system",
        "FreeRTOS task management",
        "RTOS scheduling algorithms",
        "automotive RTOS development",
        "real-time task synchronization",
    ]),
    ("phase_2_rtos/", "rtos_p2", [
        "FreeRTOS automotive application",
        "RTOS queue management",
        "real-time interrupt handling",
        "RTOS memory management",
    ]),
    ("phase_3_rtos/", "rtos_p3", [
        "production RTOS firmware",
        "automotive real-time scheduler",
        "RTOS semaphore and mutex patterns",
    ]),
    ("nxp_automotive_freertos/", "nxp_freertos", [
        "NXP automotive FreeRTOS",
        "NXP S32K MCU firmware",
        "NXP automotive BSP",
        "NXP real-time driver",
    ]),
    ("nxp_s32k_freertos_bsp/", "nxp_bsp", [
        "NXP S32K board support package",
        "NXP FreeRTOS BSP drivers",
        "NXP automotive peripheral initialization",
        "NXP MCU startup code",
    ]),
    ("car_freertos_example/", "car_freertos", [
        "automotive FreeRTOS example",
        "vehicle ECU FreeRTOS application",
    ]),
    ("advanced_middleware/", "middleware", [
        "automotive middleware",
        "SOME/IP communication",
        "CommonAPI service framework",
        "vehicle service-oriented architecture",
    ]),
    ("phase_2_middleware/", "middleware_p2", [
        "automotive middleware stack",
        "inter-ECU communication",
        "vehicle middleware services",
        "automotive IPC framework",
    ]),
    ("covesa_commonapi_core_tools/", "covesa", [
        "COVESA CommonAPI tools",
        "GENIVI middleware framework",
        "automotive service interface",
        "CommonAPI code generation",
    ]),
    ("genivi_candevstudio/", "genivi", [
        "GENIVI CAN development studio",
        "CAN bus protocol tools",
        "automotive CAN interface",
        "vehicle network diagnostics",
    ]),
    ("advanced_safety/", "safety", [
        "functional safety ISO 26262",
        "ASIL-compliant code",
        "safety-critical automotive software",
        "MISRA C compliance",
    ]),
    ("phase_3_safety/", "safety_p3", [
        "production safety-critical code",
        "ISO 26262 compliant implementation",
        "automotive safety monitoring",
        "fault-tolerant vehicle software",
    ]),
    ("functional_safety_examples/", "func_safety", [
        "functional safety examples",
        "safety pattern implementation",
        "redundancy and fault detection",
    ]),
    ("autosar_learning_project/", "autosar", [
        "AUTOSAR Classic Platform",
        "AUTOSAR software component",
        "AUTOSAR RTE interface",
        "AUTOSAR BSW module",
    ]),
    ("phase_2_academic/", "academic_p2", [
        "automotive research code",
        "vehicle systems academic implementation",
        "automotive protocol reference",
    ]),
    ("phase_3_academic/", "academic_p3", [
        "advanced automotive research",
        "vehicle systems algorithm",
        "automotive academic reference implementation",
    ]),
    ("awesome_vehicle_security/", "security", [
        "vehicle security",
        "automotive cybersecurity",
        "CAN bus security",
        "vehicle intrusion detection",
    ]),
]

#: Prompts for a first teacher batch, (id, prompt).
SAMPLE_PROMPTS = [
    ("tsn_tas_001", "Generate C code for a TSN Time-Aware Shaper (802.1Qbv) implementation with 8 priority queues for automotive Ethernet. Include the gate control list scheduling logic."),
    ("avb_srp_001", "Generate C code for AVB Stream Reservation Protocol (SRP) talker advertisement for an automotive audio stream with 48kHz sample rate, 24-bit depth, and 8 channels."),
    ("tsn_ptp_001", "Generate C code for IEEE 802.1AS Precision Time Protocol (PTP) timestamp processing for automotive time synchronization. Include nanosecond-precision timestamp handling."),
    ("eth_frame_001", "Generate C code for parsing and constructing Ethernet frames with VLAN tags (802.1Q) for automotive networking. Include CRC calculation."),
    ("sensor_fusion_001", "Generate C++ code for a sensor data fusion module that combines LIDAR, camera, and radar data for autonomous driving perception using Kalman filtering."),
]

#: Prompts for evaluation, (id, prompt).
EVAL_PROMPTS = [
    ("tsn_tas_001", "Generate C code for a TSN Time-Aware Shaper (802.1Qbv) implementation with 8 priority queues for automotive Ethernet. Include the gate control list scheduling logic."),
    ("avb_srp_001", "Generate C code for AVB Stream Reservation Protocol (SRP) talker advertisement for an automotive audio stream with 48kHz sample rate, 24-bit depth, and 8 channels."),
    ("tsn_ptp_001", "Generate C code for IEEE 802.1AS Precision Time Protocol (PTP) timestamp processing for automotive time synchronization. Include nanosecond-precision timestamp handling."),
    ("eth_frame_001", "Generate C code for parsing and constructing Ethernet frames with VLAN tags (802.1Q) for automotive networking. Include proper byte ordering."),
    ("tsn_cbs_001", "Generate C code for Credit-Based Shaper (802.1Qav) implementation for AVB traffic class management in automotive Ethernet."),
]

#: Fixed value: what a teacher is told before it generates.
TEACHER_SYSTEM = """You are an expert embedded systems engineer specializing in automotive software development.
Your expertise includes:
- Time-Sensitive Networking (TSN) protocols (IEEE 802.1Qbv, 802.1Qav, 802.1AS)
- Audio Video Bridging (AVB) for automotive infotainment
- Real-time embedded C/C++ programming
- Safety-critical code following MISRA-C guidelines
- Automotive Ethernet protocols

When generating code:
1. Follow MISRA-C/C++ guidelines for safety-critical code
2. Include proper error handling and return codes
3. Add clear, concise comments explaining the logic
4. Use appropriate data types (uint8_t, uint32_t, etc.)
5. Consider real-time constraints and deterministic execution
6. Include necessary header guards and includes

Generate production-quality code that could be used in real automotive systems."""

#: Fixed value: what a teacher is told before it corrects.
CORRECTION_SYSTEM = """You are a senior embedded systems engineer specializing in automotive software.
You are reviewing code from a junior developer learning automotive protocols (TSN/AVB).

Your task is to correct their code while:
- Maintaining the original intent and structure where possible
- Fixing bugs, safety issues, and protocol compliance problems
- Following MISRA-C guidelines for safety-critical code
- Ensuring TSN/AVB protocol compliance
- Adding proper error handling
- Using appropriate data types (uint8_t, uint32_t, etc.)

Output ONLY the corrected code with comments. No explanations outside the code."""
